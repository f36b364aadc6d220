"""Mixing sources to target weights over distributed prefix sums.

Every document gets a hash-random key.  Within its source the keys are cut into
equal ranges; range totals are summed up first, so that each range knows the
words before it, and a window inside the range gives each document its own
prefix.  A source with a budget of q whole passes and r words takes q times
every document, and once more those that lie before r, the last one in part.
No window ever holds more than a range, however large its source.

Defined results: a null text has size 0 and takes nothing; the null source comes
last; rows equal in all columns follow each other and share the budget; a null
id is a key like any other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch, fields, passing, with_row_key, word_count

# The weights by order of sources, and the most passes.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
RANGE_ROWS = 4_000
# A plan of so many rows of five short columns stays far below 10 MB; beyond it
# Spark joins as it sees fit.
BROADCAST_SOURCES = 50_000


def targets(
    sizes: Sequence[int], weights: Sequence[float], most: float, share: float = 1.0
) -> list[float]:
    """Share out the words by weight; what a source can't take goes to the rest."""
    open_, left = set(range(len(sizes))), share * sum(sizes)
    result = [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        if not full:
            for i in open_:
                result[i] = unit * weights[i]
            break
        for i in full:
            result[i] = most * float(sizes[i])
            left -= result[i]
        open_ -= full
    return result


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    range_rows: int = RANGE_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, source, size, source_size, target, taken, *carry), one row per input row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        *carry,
    ).withColumn("key", F.xxhash64("id", F.lit(seed)))
    rows = scratch.store(rows, "sized")

    # One row per source: the names of sources are few, their documents many.
    by_source = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    found = sorted(
        by_source.collect(),
        key=lambda r: (r.source is None, (r.source or "").encode()),
    )
    cycle = [weights[i % len(weights)] for i in range(len(found))]
    wanted = targets([r.source_size for r in found], cycle, most)
    plan = spark.createDataFrame(
        [
            (r.source, r.source_size, t, max(1, math.ceil(r.n / range_rows)))
            for r, t in zip(found, wanted, strict=True)
        ],
        "source string, source_size long, target double, ranges long",
    )
    # Keys are uniform over the signed 64-bit range: equal slices are equal shares.
    slot = F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * F.col("ranges"))
    if len(found) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        rows["source"],
        "id",
        "size",
        "key",
        "source_size",
        "target",
        F.least(slot, F.col("ranges") - 1).cast("long").alias("slot"),
        *carry,
    )
    totals = rows.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("slot").rowsBetween(
        W.unboundedPreceding, -1
    )
    starts = totals.select(
        F.col("source").alias("of"),
        F.col("slot").alias("at"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"),
    )
    inside = (
        W.partitionBy("source", "slot")
        .orderBy("key", F.col("id").asc_nulls_first(), "size", *carry)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    placed = rows.withColumn("prefix", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(
        starts,
        placed["source"].eqNullSafe(starts["of"])
        & (placed["slot"] == starts["at"]),
    )
    budget = F.floor(F.col("target") + 0.5).cast("long")
    passes = F.expr("if(source_size = 0, 0, budget div source_size)")
    return (
        placed.withColumn("budget", budget)
        .withColumn("passes", passes)
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size"))
        .withColumn("part", F.col("rest") - F.col("start") - F.col("prefix"))
        .withColumn("part", F.greatest(F.lit(0), F.least("size", "part")))
        .select(
            "id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("passes") * F.col("size") + F.col("part")).alias("taken"),
            *carry,
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix as rows: a document once for each pass that takes it.

    The document at which a source's budget ends is in the last pass if at
    least half of it lies within the budget; texts are never cut.  Rows equal in all
    columns can't be told apart: one of them stands for the copies of all.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    keyed = with_row_key(docs)
    copies = F.expr("cast(floor(taken / size + 0.5) as int)")
    with passing(spark):
        taken = mix(fields(keyed, "doc_id", "text", "source"), carry=("row",))
        taken = taken.filter("size > 0").withColumn("copies", copies).groupBy("row")
        taken = taken.agg(F.sum("copies").cast("int").alias("n"), F.count(F.lit(1)).alias("rows"))
        chosen = scratch.store(taken.filter("n > 0"), "chosen")
    single = keyed.join(chosen.filter("rows = 1").select("row", "n"), "row")
    twins = chosen.filter("rows > 1").select("row", "n")
    equal = keyed.join(twins, "row").dropDuplicates(["row"])
    passes = single.unionByName(equal).withColumn(
        "pass", F.explode(F.sequence(F.lit(1), F.col("n")))
    )
    return passes.select("doc.*")
