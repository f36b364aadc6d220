"""Exact top-k search by histogram selection.

Vectors are scaled and rounded down to integers, so that scores are exact.  They
are dealt by hash into blocks; every block of queries meets every block of
candidates of its dimension, and a task scores such a pair with one matrix product.
Blocks of candidates lie in shares, and a block of queries is sent once to each
share, not to each block: ``SHARES`` times, until a share would hold more than
``TOGETHER`` blocks.  Blocks are never broadcast: Spark reckons what they are repeated
to from the size before, so that it would send any amount by way of the driver.

1. For each query the scores of all candidates go into a histogram of ``BINS``
   bins over the range that the lengths of the vectors allow.  The histograms of
   all pairs are added up and the bin that holds the k-th highest score becomes
   the next range, until it is a single value: two rounds for scores below 2^15,
   eight for any long.
2. Once more all pairs are scored, and what exceeds the k-th value is kept, which
   are fewer than k rows in all.  Of the scores equal to it a pair gives only as
   many as are still wanted, those with the smallest ids; the rest of the tie is
   settled by id over all pairs.

A pair's histogram is cut below the bin in which its own count reaches what is
wanted: the k-th highest of all can't be lower, and every bin above is whole.  So a
pair sends about k rows a query however many candidates it has, and a task adds up
its pairs before the shuffle.

Bounds: a block has about ``QUERIES`` or ``CANDIDATES`` vectors, and a task holds the
candidates of a share; the driver only sees counts and the widest range.  The work is all queries times all candidates.

Defined results: vectors that are null or hold null or non-finite components take
no part; vectors only meet those of their dimension; a row is not its own
candidate, but rows that repeat its id are, and each asks for itself
(``query_row`` tells them apart); a null id never asks and comes last in a tie;
fewer candidates than k give all of them; a score beyond 4 * 10^18 fails the
job; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch, passing

BINS = 256
QUERIES = 1024
CANDIDATES = 4096
SHARES = 64  # of the candidates; more where one would hold more than TOGETHER blocks
TOGETHER = 16
AT_ONCE = 128  # queries scored at once
EXACT = 2.0**53
BEYOND = 4 * 10**18  # scores and the differences between them fit a long

BLOCK = "d int, block long, row binary, id binary, no_id binary, v binary"
STATE = ("lo", "span", "above")
# A block is one long row: the writer looks at sizes after each, not first after 100.
LONG_ROWS = {
    "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, d, v, length): the vectors that take part, as integers."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x))
    squares = F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), "asks")
    rows = rows.filter(finite).withColumn("v", whole)
    return rows.select("id", "asks", F.size("v").alias("d"), "v", F.sqrt(squares).alias("length"))


def _narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them all."""
    for kind in (np.int8, np.int16, np.int32) if v.size else ():
        if np.iinfo(kind).min <= v.min() and v.max() <= np.iinfo(kind).max:
            return v.astype(kind)
    return v


def _pack(state: bool) -> Callable:
    """One row of a block's vectors, ids and, for queries, ranges."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        first = {c: rows.column(c)[:1] for c in ("d", "block")}
        ids = rows.column("id")
        held = {
            "row": rows.column("row").to_numpy(),
            "id": ids.fill_null(0).to_numpy(),
            "no_id": ids.is_null().to_numpy(),
            "v": _narrow(
                rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ),
        }
        if state:
            held |= {c: rows.column(c).to_numpy() for c in STATE}
        packed = {c: pa.array([a.tobytes()], pa.binary()) for c, a in held.items()}
        return pa.table({**first, **packed})

    return pack


def _numbers(batch: pa.RecordBatch, column: str, row: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_py(), kind)


def _vectors(batch: pa.RecordBatch, column: str, row: int, n: int, d: int) -> np.ndarray:
    width = len(batch.column(column)[row].as_py()) // max(n * d, 1)
    return _numbers(batch, column, row, f"i{width or 8}").reshape(n, d)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors as longs."""
    longest = [math.sqrt(float((m.astype(float) ** 2).sum(axis=1).max())) for m in (q, c)]
    if longest[0] * longest[1] < EXACT / 2:
        # Every partial sum is an integer that a double holds.
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    if exact.size and max(abs(exact.min()), abs(exact.max())) > BEYOND:
        raise OverflowError("a score exceeds a long")
    return exact.astype(np.int64)


def _scored(batch: pa.RecordBatch, row: int) -> Iterator[tuple]:
    """(queries' slice, scores, own) of a pair, some queries at a time."""
    d = batch.column("d")[row].as_py()
    asked, found = _numbers(batch, "q_row", row), _numbers(batch, "c_row", row)
    q = _vectors(batch, "q_v", row, len(asked), d)
    c = _vectors(batch, "c_v", row, len(found), d)
    order = np.argsort(found)
    for at in range(0, len(asked), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        place = np.searchsorted(found, asked[part], sorter=order)
        place = order[np.minimum(place, len(found) - 1)]
        own = np.zeros((len(place), len(found)), bool)
        own[np.arange(len(place)), place] = found[place] == asked[part]
        yield part, _products(q[part], c), own


def _histograms(k: int) -> Callable:
    """(row, wanted, bin, n): the upper bins of each query's scores in its range."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked = _numbers(batch, "q_row", row)
                lo, span, above = (_numbers(batch, f"q_{c}", row) for c in STATE)
                width = np.maximum(-(-span // BINS), 1)
                for part, scores, own in _scored(batch, row):
                    from_lo = scores - lo[part, None]
                    inside = (from_lo >= 0) & (from_lo < span[part, None]) & ~own
                    query, _ = np.nonzero(inside)
                    bin_ = from_lo[inside] // width[part][query]
                    size = len(from_lo) * BINS
                    n = np.bincount(query * BINS + bin_, minlength=size).reshape(-1, BINS)
                    higher = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
                    wanted = k - above[part]
                    at, bins = np.nonzero((n > 0) & (higher < wanted[:, None]))
                    columns = (asked[part][at], wanted[at], bins, n[at, bins])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in columns], ["row", "wanted", "bin", "n"]
                    )

    return count


def _winners(k: int) -> Callable:
    """(row, query_id, vec_id, score, of): above the k-th value, and its tie's first."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked, query_id = (_numbers(batch, f"q_{c}", row) for c in ("row", "id"))
                kth, _, above = (_numbers(batch, f"q_{c}", row) for c in STATE)
                found, ids = (_numbers(batch, f"c_{c}", row) for c in ("row", "id"))
                no_id = _numbers(batch, "c_no_id", row, bool)
                by_id = np.lexsort((found, ids, no_id))
                for part, scores, own in _scored(batch, row):
                    scores, own = scores[:, by_id], own[:, by_id]
                    level = kth[part, None]
                    tied = (scores == level) & ~own
                    first = tied & (tied.cumsum(axis=1) <= (k - above[part])[:, None])
                    at, place = np.nonzero(((scores > level) & ~own) | first)
                    of = by_id[place]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(asked[part][at], pa.int64()),
                            pa.array(query_id[part][at], pa.int64()),
                            pa.array(ids[of], pa.int64(), mask=no_id[of]),
                            pa.array(scores[at, place], pa.int64()),
                            pa.array(found[of], pa.int64()),
                        ],
                        ["row", "query_id", "vec_id", "score", "of"],
                    )

    return choose


def _pairs(queries: DataFrame, candidates: DataFrame, blocks: int) -> DataFrame:
    """Every block of queries next to every block of candidates of its dimension."""
    schema = BLOCK + "".join(f", {c} binary" for c in STATE)
    packed = queries.groupBy("d", "block").applyInArrow(_pack(state=True), schema)
    q = packed.select("d", *[F.col(c).alias(f"q_{c}") for c in ("row", "id", "v", *STATE)])
    shares = max(min(blocks, SHARES), math.ceil(blocks / TOGETHER))
    every = F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))
    q = q.withColumn("share", F.explode(every))
    c = candidates.select(
        "d",
        F.pmod("block", F.lit(shares)).cast("long").alias("share"),
        *[F.col(c).alias(f"c_{c}") for c in ("row", "id", "no_id", "v")],
    )
    # Dealt out by number: a task's work is its pairs, which their bytes say little of.
    by = (2 * shares, "d", "share")
    return q.repartition(*by).hint("merge").join(c.repartition(*by), ["d", "share"])


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_rows: int = QUERIES,
    candidate_rows: int = CANDIDATES,
) -> DataFrame:
    """(query_row, query_id, rank, vec_id, score): each query's k highest scores.

    ``asks`` says over the table's columns which rows are queries.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    marked = vectors.select(id_col, vector_col, F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = quantised(marked, id_col, vector_col, scale)
    rows = scratch.store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")

    asking = F.col("asks") & F.col("id").isNotNull()
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(asking).alias("asking")).first()
    blocks = max(1, math.ceil(n["all"] / candidate_rows))
    query_blocks = max(1, math.ceil(n["asking"] / query_rows))

    def block(of: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(of)).cast("long")

    candidates = rows.withColumn("block", block(blocks)).drop("asks", "length")
    candidates = candidates.groupBy("d", "block").applyInArrow(_pack(state=False), BLOCK)
    with passing(vectors.sparkSession):
        candidates = scratch.store(candidates, "candidates", **LONG_ROWS)

    # No score exceeds the product of the lengths; one row a dimension.
    reach = scratch.store(rows.groupBy("d").agg(F.max("length").alias("most")), "lengths")
    limit = F.least(F.col("length") * F.col("most") * (1 + 1e-9) + 1, F.lit(float(BEYOND)))
    queries = (
        rows.filter(asking)
        .join(reach, "d")
        .withColumn("hi", F.ceil(limit))
        .withColumns(
            {
                "lo": -F.col("hi"),
                "span": 2 * F.col("hi") + 1,
                "above": F.lit(0).cast("long"),
                "block": block(query_blocks),
            }
        )
        .select("row", "id", "d", "v", "block", *STATE)
    )
    queries = scratch.store(queries, "queries-0")
    turn = 0
    while (queries.agg(F.max("span")).first()[0] or 0) > 1:
        with passing(vectors.sparkSession):
            queries = scratch.store(
                _narrowed(queries, _pairs(queries, candidates, blocks), k), f"queries-{turn + 1}"
            )
        scratch.drop(f"queries-{turn}")
        turn += 1

    won = _pairs(queries, candidates, blocks).mapInArrow(
        _winners(k), "row long, query_id long, vec_id long, score long, of long"
    )
    best = W.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "of")
    ranked = won.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("row").alias("query_row"), "query_id", "rank", "vec_id", "score")


def _narrowed(queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The queries with the bin that holds the k-th score as their range.

    Where all scores together are fewer than k there is none: the range becomes
    empty and its lower end stays below every score.
    """
    counted = pairs.mapInArrow(_histograms(k), "row long, wanted long, bin long, n long")
    counted = counted.groupBy("row", "wanted", "bin").agg(F.sum("n").alias("n"))
    down = W.partitionBy("row").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    reached = counted.withColumn("reached", F.sum("n").over(down))
    kth = reached.filter("reached >= wanted and reached - n < wanted").select(
        "row", "bin", (F.col("reached") - F.col("n")).alias("higher")
    )
    width = F.expr(f"(span + {BINS - 1}) div {BINS}")
    return (
        queries.join(kth, "row", "left")
        .withColumn("width", width)
        .withColumns(
            {
                "lo": F.expr("lo + coalesce(bin, 0) * width"),
                "above": F.expr("above + coalesce(higher, 0)"),
                "span": F.expr("if(bin is null, 0, least(width, span - bin * width))"),
            }
        )
        .select(*queries.columns)
    )
