"""Conflict-constrained best-fit packing of documents into token bins.

Documents longer than a bin are cut into full bins and a remainder.  The pieces
are dealt by hash into shards of about ``SHARD`` pieces, many more than a bin
holds, so that packing a shard on its own costs next to no space while no task
ever sees more than a shard.  Inside a shard the pieces go from long to short,
each into the open bin with the smallest residual that still takes it and holds
neither its source nor its duplicate cluster; the search starts at the successor
of the piece's length among the residuals and goes on to the next larger
residual until a compatible bin is found, else a new bin is opened.

The bins' source and cluster bitmaps are kept transposed, as one bitmap of bins
per source and per cluster: all bins of one residual are tested by one AND.

Defined results: a text's tokens are its words and one end, so an empty or null
text takes one; null sources are one source; repeated rows conflict by their
cluster and so never share a bin; ties go by id, then piece; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.common import Scratch, folded, text_id

CAPACITY = 2048
SHARD = 8192

SCHEMA = (
    "id string, source string, piece int, start long, length int, "
    "shard long, bin int, position int"
)


@F.pandas_udf(T.StructType().add("tokens", T.LongType()).add("cluster", T.BinaryType()))
def measured(texts: pd.Series) -> pd.DataFrame:
    bodies = map(folded, texts)
    rows = [(len(body.split()) + 1, hashlib.md5(body).digest()) for body in bodies]
    return pd.DataFrame(rows, columns=["tokens", "cluster"])


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, position) of each (length, source, cluster), in the given order."""
    placed: list[tuple[int, int]] = []
    residual: list[int] = []
    at_residual = [0] * (capacity + 1)  # bitmap of the bins with this residual
    levels = 0  # bitmap of the residuals that some bin has
    open_bins = 0
    with_source: dict[object, int] = {}
    with_cluster: dict[object, int] = {}
    for length, source, cluster in pieces:
        taken = with_source.get(source, 0) | with_cluster.get(cluster, 0)
        chosen = -1
        if open_bins & ~taken:
            above = levels >> length
            level = length
            while above:
                step = (above & -above).bit_length() - 1
                level += step
                fitting = at_residual[level] & ~taken
                if fitting:
                    chosen = (fitting & -fitting).bit_length() - 1
                    break
                above >>= step + 1
                level += 1
        if chosen < 0:
            chosen = len(residual)
            residual.append(capacity)
        else:
            at_residual[residual[chosen]] ^= 1 << chosen
            if not at_residual[residual[chosen]]:
                levels ^= 1 << residual[chosen]
            open_bins ^= 1 << chosen
        placed.append((chosen, capacity - residual[chosen]))
        left = residual[chosen] = residual[chosen] - length
        bit = 1 << chosen
        if left:
            at_residual[left] |= bit
            levels |= 1 << left
            open_bins |= bit
        with_source[source] = with_source.get(source, 0) | bit
        with_cluster[cluster] = with_cluster.get(cluster, 0) | bit
    return placed


def _pack_shard(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows["no_id"] = rows["id"].isna()
        rows["number"] = np.array([int(i or 0) for i in rows["id"].where(~rows["no_id"], None)], np.int64)
        rows = rows.sort_values(
            ["length", "no_id", "number", "piece", "cluster"],
            ascending=[False, True, True, True, True],
        )
        source = rows["source"].where(rows["source"].notna(), None)
        placed = best_fit(
            list(zip(rows["length"], source, rows["cluster"], strict=True)), capacity
        )
        rows["bin"] = [b for b, _ in placed]
        rows["position"] = [p for _, p in placed]
        return rows.drop(columns=["cluster", "no_id", "number"])

    return pack


def pack(
    docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD
) -> DataFrame:
    """(id, source, piece, start, length, shard, bin, position) of every piece."""
    scratch = Scratch(docs.sparkSession, "packing")
    items = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.col("source").cast("string").alias("source"),
        measured(F.col("text").cast("string")).alias("m"),
    ).select("id", "source", "m.tokens", "m.cluster")
    last = F.expr(f"(tokens - 1) div {capacity}")
    items = scratch.store(items.withColumn("last", last), "items")
    n = items.agg(F.sum(F.col("last") + 1)).first()[0] or 0
    shards = max(1, math.ceil(n / shard))
    pieces = (
        items.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("last").cast("int"))))
        .withColumn("start", F.col("piece").cast("long") * capacity)
        .withColumn(
            "length", F.least(F.lit(capacity), F.col("tokens") - F.col("start")).cast("int")
        )
        .withColumn(
            "shard", F.pmod(F.xxhash64("id", "cluster", "piece"), F.lit(shards)).cast("long")
        )
        .select(text_id("id"), "source", "piece", "start", "length", "shard", "cluster")
    )
    packed = pieces.groupBy("shard").applyInPandas(_pack_shard(capacity), SCHEMA)
    return packed.withColumn("id", F.col("id").cast("long"))
