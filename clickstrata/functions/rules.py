"""Rules over rows: a condition plus the record it emits when it holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``when`` decides, ``record`` is the struct a hit adds to the output."""

    name: str
    when: Column
    record: Column


def any_hit(rules: Sequence[Rule]) -> Column:
    """Whether a row breaks any rule; FALSE where the conditions are NULL."""
    return F.coalesce(reduce(or_, [rule.when for rule in rules]), F.lit(False))


def emit(rows: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ()) -> DataFrame:
    """All hits of all rules as a bag, reading ``rows`` once.

    One rule is a plain filter.  Several become one array per row that is
    exploded, so a row hit by two rules yields two records and the input is
    neither scanned nor shuffled once per rule.  Rows without a hit leave
    before any array or text is built.
    """
    kept = [F.col(name) for name in keep]
    suspects = rows.filter(any_hit(rules))
    if len(rules) == 1:
        found = suspects.select(*kept, rules[0].record.alias("_hit"))
    else:
        each = F.array(*[F.when(rule.when, rule.record) for rule in rules])
        found = suspects.select(*kept, F.explode(each).alias("_hit")).filter(
            F.col("_hit").isNotNull()
        )
    return found.select(*kept, "_hit.*")


def hits(rules: Sequence[Rule]) -> Column:
    """The records of every rule a row breaks, as an array; NULL when none."""
    each = [F.when(rule.when, rule.record) for rule in rules]
    return F.when(any_hit(rules), F.array_compact(F.array(*each)))
