"""Exact deduplication by 128-bit content hash with a byte comparison.

1. Every row is reduced to (id, MD5, SHA-256) of its normalised text; counting
   by MD5 collapses hot groups before the shuffle.
2. Only texts whose hash repeats are read again and grouped by hash *and text*:
   equal bytes fall into one group, colliding ones into several.  The salt in
   the join lets a hot hash run in many tasks, and equal texts of a task
   collapse before they are shuffled.
3. Each row takes the decision of its (MD5, SHA-256) group.  Step 2 fails the
   job should two different texts ever agree in both hashes.

Defined results: a null text counts as empty; a row with a null id is kept only
if all ids of its group are null; rows that repeat both id and text stand for
the same document and share its decision; an empty table gives no rows.
``without_copies`` keeps exactly one row of each group of equal texts.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.common import Scratch, fields, folded, passing, with_row_key, without_rows

SALTS = 8


@F.pandas_udf(T.StructType().add("h", T.BinaryType()).add("sha", T.StringType()))
def content_hash(texts: pd.Series) -> pd.DataFrame:
    """MD5 and SHA-256 of the normalised text."""
    bodies = map(folded, texts)
    rows = [(hashlib.md5(b).digest(), hashlib.sha256(b).hexdigest()) for b in bodies]
    return pd.DataFrame(rows, columns=["h", "sha"])


@F.pandas_udf(T.StringType())
def normalised(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: folded(text).decode())


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    salts: int = SALTS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256, *carry), one row per input row."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *carry
    )
    hashed = rows.withColumn("hash", content_hash("text"))
    digests = scratch.store(hashed.select("id", "hash.h", "hash.sha", *carry), "digests")

    repeated = digests.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = scratch.store(repeated.select("h"), "repeated")
    salted = repeated.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    suspects = hashed.select(
        "id",
        "text",
        "hash.h",
        "hash.sha",
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    ).join(salted, ["h", "salt"], "left_semi")
    same_bytes = (
        suspects.groupBy("h", "sha", normalised("text").alias("body"))
        .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .drop("body")
        .groupBy("h", "sha")
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("texts"),
        )
        .withColumn(
            "group_size",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                F.raise_error("two texts agree in MD5 and SHA-256").cast("long")
            ),
        )
    )
    groups = scratch.store(same_bytes.drop("texts"), "groups")
    scratch.drop("repeated")
    return (
        digests.join(groups, ["h", "sha"], "left")
        .withColumn("alone", F.col("group_size").isNull())
        .select(
            F.col("id"),
            F.expr("if(alone, id, keep_id)").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.expr("alone or id <=> keep_id").alias("kept"),
            F.col("sha").alias("text_sha256"),
            *carry,
        )
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    spark = docs.sparkSession
    kept = Scratch(spark, "exact-dedup")
    keyed = with_row_key(docs)
    with passing(spark):
        scratch = Scratch(spark, "exact-dedup-rows")
        rows = fields(keyed, "doc_id", "text")
        decided = exact_dedup(rows, keep=keep, carry=("row",)).filter("group_size > 1")
        decided = scratch.store(decided.select("text_sha256", "kept", "row"), "decided")
        best = decided.filter("kept").groupBy("text_sha256").agg(F.min("row").alias("best"))
        best = scratch.store(best, "best")
        gone = decided.join(best, "text_sha256").filter("row != best").select("row")
        gone = kept.store(gone.distinct(), "gone")
        twins = decided.join(best.select(F.col("best").alias("row")), "row", "left_semi")
        twins = twins.groupBy("row").count().filter("count > 1").select("row")
        twins = kept.store(twins, "twins")
    return without_rows(keyed, gone, twins)
