"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are assigned to the nearest of k-means centroids, fitted on a bounded
sample of ``SAMPLE`` vectors; every vector is indexed.  A query looks into as many
clusters as hold ``RECALL`` of the neighbours inside the sample.  The unit residual from the
centroid is rotated at random and kept as one sign bit per dimension with two
correction scalars, its length and its inner product with the code.  A query's
inner product with the code, divided by that scalar, estimates the one with the
vector without bias; the same scalar bounds the error.  In each block of a probed
cluster a vector is reranked by its exact distance only if its lower bound does
not exceed the k-th smallest upper bound.

Clusters are cut into blocks of vectors and of queries, so the size of a group is
bounded however large a cluster, such as one of equal vectors, becomes.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do those of another than the most common dimension
(the smaller in a tie); rows with the query's id are not its candidates; a query
id that repeats is asked once, with its smallest vector; ties go to the smaller
id; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch

SAMPLE = 16_384
MOST_CLUSTERS = 1024
RECALL = 0.98  # share of neighbours that the probed clusters hold
TRIED = 256  # vectors of the sample on which the number of probes is measured
BLOCK = 4096  # vectors or queries of a cluster in one group
EPSILON = 3.0  # error bound in standard deviations
AT_ONCE = 128  # queries estimated at once

CODE = "cluster int, code binary, length double, ip double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.filter(
        F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    ).withColumn("d", F.size("v"))


def k_means(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    random = np.random.default_rng(seed)
    centres = sample[random.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        nearest = _nearest(sample, centres, 1)[:, 0]
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    squared = (centres**2).sum(axis=1) - 2 * points @ centres.T
    return np.argsort(squared, axis=1, kind="stable")[:, :n]


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Fewest nearest clusters that hold this share of the neighbours in the sample.

    Neighbours among all vectors are closer than those in a sample, so the share
    is higher there.
    """
    home = _nearest(sample, centres, 1)[:, 0]
    ranks = []
    for query in sample[:TRIED]:
        near = np.argsort(np.square(sample - query).sum(axis=1))[1 : k + 1]
        order = _nearest(query[None], centres, len(centres))[0]
        ranks.append(np.argsort(order)[home[near]])
    found = np.sort(np.concatenate(ranks))
    if not len(found):
        return len(centres)
    return int(found[math.ceil(recall * len(found)) - 1]) + 1


def rotation(d: int, seed: int = 0) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def encode(points: np.ndarray, clusters: np.ndarray, centres, rotate) -> pd.DataFrame:
    residual = points - centres[clusters]
    length = np.linalg.norm(residual, axis=1)
    unit = residual / np.where(length > 0, length, 1.0)[:, None] @ rotate
    ip = np.abs(unit).sum(axis=1) / math.sqrt(points.shape[1])
    return pd.DataFrame(
        {
            "cluster": clusters.astype(np.int32),
            "code": [row.tobytes() for row in np.packbits(unit > 0, axis=1)],
            "length": length,
            "ip": ip,
        }
    )


def bounds(queries: np.ndarray, signs: np.ndarray, length, ip, centre, rotate):
    """Estimated squared distances (queries x vectors) and their error bounds."""
    d = len(centre)
    residual = queries - centre
    norm = np.linalg.norm(residual, axis=1)[:, None]
    unit = residual / np.where(norm > 0, norm, 1.0) @ rotate
    safe = np.where(ip > 0, ip, 1.0)
    cosine = (unit @ signs.T) / math.sqrt(d) / safe
    spread = np.sqrt(np.maximum(1 - safe**2, 0)) / safe * EPSILON / math.sqrt(max(d - 1, 1))
    both = 2 * norm * length
    return norm**2 + length**2 - both * cosine, both * spread


def _search(shared, k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(vectors) and len(queries):
            centres, rotate = shared.value
            centre = centres[vectors["cluster"].iloc[0]]
            points = np.stack(vectors["v"].to_list())
            ids = vectors["id"].to_numpy()
            d = points.shape[1]
            packed = np.frombuffer(b"".join(vectors["code"]), np.uint8)
            bits = np.unpackbits(packed.reshape(len(ids), -1), axis=1, count=d)
            signs = bits.astype(np.float64) * 2 - 1
            length, ip = vectors["length"].to_numpy(), vectors["ip"].to_numpy()
            asked = np.stack(queries["v"].to_list())
            asked_ids = queries["id"].to_numpy()
            for at in range(0, len(asked), AT_ONCE):
                part, part_ids = asked[at : at + AT_ONCE], asked_ids[at : at + AT_ONCE]
                estimate, error = bounds(part, signs, length, ip, centre, rotate)
                own = part_ids[:, None] == ids
                upper = np.where(own, np.inf, estimate + error)
                lower = np.where(own, np.inf, estimate - error)
                limit = np.full(len(part), np.inf)
                if len(ids) > k:
                    limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
                for i, query in enumerate(part):
                    near = np.flatnonzero((lower[i] <= limit[i]) & ~own[i])
                    exact = np.sqrt(np.square(points[near] - query).sum(axis=1))
                    order = np.lexsort((ids[near], exact))[:k]
                    found.append(
                        pd.DataFrame(
                            {
                                "query_id": part_ids[i],
                                "vec_id": ids[near][order],
                                "score": exact[order],
                            }
                        )
                    )
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat(found)

    return search


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "knn")
    rows = usable(vectors, id_col, vector_col)
    common = rows.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    rows, n = rows.filter(F.col("d") == common["d"]).drop("d"), common["count"]
    drawn = rows.orderBy(F.xxhash64("id", F.lit(5)), "v").limit(SAMPLE).collect()
    sample = np.array([row.v for row in drawn])
    clusters = max(1, min(MOST_CLUSTERS, len(sample) // 16, round(math.sqrt(n) / 2)))
    fitted = k_means(sample, clusters)
    shared = spark.sparkContext.broadcast((fitted, rotation(sample.shape[1])))
    probes = probes_for(sample, fitted, k, recall)

    @F.pandas_udf(f"struct<{CODE.replace(' ', ': ').replace(',:', ',')}>")
    def coded(v: pd.Series) -> pd.DataFrame:
        centres, rotate = shared.value
        points = np.stack(v.to_list())
        return encode(points, _nearest(points, centres, 1)[:, 0], centres, rotate)

    @F.pandas_udf("array<int>")
    def probing(v: pd.Series) -> pd.Series:
        centres, _ = shared.value
        found = _nearest(np.stack(v.to_list()), centres, probes)
        return pd.Series(list(found.astype(np.int32)))

    index = rows.withColumn("c", coded("v")).select("id", "v", "c.*")
    index = scratch.store(index, "index")
    asked = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.withColumn("cluster", F.explode(probing("v")))
    asked = scratch.store(asked, "asked")

    # At most MOST_CLUSTERS rows.
    sizes = index.groupBy("cluster").agg(F.ceil(F.count("id") / BLOCK).alias("blocks"))
    wide = asked.groupBy("cluster").agg(F.ceil(F.count("id") / BLOCK).alias("teams"))
    cut = sizes.join(wide, "cluster")
    cut = F.broadcast(scratch.store(cut, "cut"))
    dealt = F.pmod(F.xxhash64("id"), "blocks").alias("block")
    teams = F.explode(F.sequence(F.lit(0).cast("long"), F.col("teams") - 1)).alias("team")
    left = index.join(cut, "cluster").select("cluster", dealt, teams, *index.columns[:2], *index.columns[3:])
    dealt = F.pmod(F.xxhash64("id"), "teams").alias("team")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    right = asked.join(cut, "cluster").select("cluster", blocks, dealt, "id", "v")
    keys = ["cluster", "block", "team"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_search(shared, k), "query_id long, vec_id long, score double")
    )
    ranked = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
