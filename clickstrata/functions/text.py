"""Message text from mixed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown(value: Column) -> Column:
    """A value as text, with NULL spelled out."""
    return F.coalesce(value.cast("string"), F.lit("NULL"))


def message(*parts: str | Column) -> Column:
    """Concatenate literals (str) and values (Column) without NULL wiping it out."""
    return F.concat(
        *[F.lit(part) if isinstance(part, str) else shown(part) for part in parts]
    )
