"""Importance resampling towards a target distribution, on Arrow kernels.

Features are the runs of 1 to ``longest`` consecutive words of a text, hashed into
``buckets`` by the CRC of their bytes.  Inside a task a batch of texts goes through
``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``;
dictionary indices shifted against each other form the longer runs, which are
encoded again, so that only the distinct runs of a batch are hashed: the CRC of a
run is continued from that of its beginning.

1. The features of the corpus and of the target are counted by bucket: a task
   sends at most ``buckets`` counts.  The gain of a bucket is the scaled log
   quotient of its smoothed shares in target and corpus.
2. The texts are encoded again rather than stored in between, the gains are taken
   by bucket, summed up by document and averaged.
3. A Gumbel number that only depends on seed and id is added; the highest scores
   of the long enough documents are drawn.  A range sort numbers them, so neither
   a task nor the driver sees more than its range.

What the driver holds: two lists of ``buckets`` counts and a few totals.

Defined results: a null text has no words; without features the weight is 0; the
number of a null id is that of an empty one, and it comes last among equal scores;
rows that repeat an id share its number and are drawn one by one; an empty table
gives no rows, an empty target takes every share as equally likely.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch, range_numbered

# What parts words (all of ASCII but digits and lower-case letters),
# the smoothing and the scale of gains.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SMOOTHING = 10_000
SCALE = 1000

FEATURED = "id long, n_words long, n_features long, weight long"


def hashed_runs(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple]:
    """For each length, (document, bucket) of every run of so many words."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), GAPS)
    flat = pc.list_flatten(parts)
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    filled = pc.greater(pc.binary_length(flat), 0)
    document = np.repeat(np.arange(len(texts)), lengths)[filled.to_numpy(zero_copy_only=False)]
    encoded = flat.filter(filled).dictionary_encode()
    word = encoded.indices.to_numpy().astype(np.int64)
    spelled = [w.encode() for w in encoded.dictionary.to_pylist()]
    crc = [zlib.crc32(w) for w in spelled]
    yield document, np.array(crc, np.int64)[word] % buckets if crc else word
    spaced = [b" " + w for w in spelled]
    run = word
    for n in range(2, longest + 1):
        if len(word) < n:
            return
        inside = document[n - 1 :] == document[: 1 - n]
        # The run that begins here is shorter by one word; inside is False where
        # it already left its document.
        pairs = run[: len(inside)] * len(spaced) + word[n - 1 :]
        again = pa.array(pairs[inside]).dictionary_encode()
        begun, last = np.divmod(again.dictionary.to_numpy(), max(len(spaced), 1))
        crc = [
            zlib.crc32(spaced[w], crc[r])
            for r, w in zip(begun.tolist(), last.tolist(), strict=True)
        ]
        index = again.indices.to_numpy().astype(np.int64)
        yield document[: len(inside)][inside], np.array(crc, np.int64)[index] % buckets if crc else index
        run = np.zeros(len(inside), np.int64)
        run[inside] = index


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return pc.fill_null(batch.column("text"), "")


def _counting(longest: int, buckets: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket in hashed_runs(_texts(batch), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        full = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int64()), pa.array(total[full], pa.int64())], ["bucket", "n"]
        )

    return count


def feature_counts(texts: DataFrame, longest: int = 2, buckets: int = BUCKETS) -> list[int]:
    """How many features of all the texts fall into each bucket."""
    counted = texts.mapInArrow(_counting(longest, buckets), "bucket long, n long")
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n"))
    result = [0] * buckets
    for row in sums.collect():  # at most one row a bucket
        result[row.bucket] = row.n
    return result


def log_gains(corpus: list[int], target: list[int]) -> list[int]:
    """Scaled log quotient of each bucket's shares, rounded down."""
    of, to = sum(corpus) + SMOOTHING, sum(target) + SMOOTHING
    return [
        math.floor(SCALE * math.log((t + 1) * of / ((s + 1) * to)))
        for s, t in zip(corpus, target, strict=True)
    ]


def _weighing(gains: np.ndarray, longest: int) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.arange(batch.num_rows + 1)
            sums = np.zeros(batch.num_rows, np.int64)
            features = np.zeros(batch.num_rows, np.int64)
            words = None
            for document, bucket in hashed_runs(_texts(batch), longest, len(gains)):
                edges = np.searchsorted(document, rows)
                before = np.concatenate([[0], np.cumsum(gains[bucket])])
                sums += before[edges[1:]] - before[edges[:-1]]
                found = np.diff(edges)
                features += found
                words = found if words is None else words
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            numbers = [pa.array(x, pa.int64()) for x in (words, features, weight)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *numbers], ["id", "n_words", "n_features", "weight"]
            )

    return weigh


def weighed(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = 2,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``docs``."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    wanted = target.select(F.col(target_text_col).cast("string").alias("text"))
    gains = log_gains(
        feature_counts(rows.select("text"), longest, buckets),
        feature_counts(wanted, longest, buckets),
    )
    return rows.mapInArrow(_weighing(np.array(gains, np.int64), longest), FEATURED)


def gumbel(id_col: str, seed: int):
    """Scaled Gumbel number of an id, the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(u)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = 25,
    least_words: int = 20,
    seed: int = 7,
    **options,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; undrawn: null rank.

    ``share`` percent, rounded down, of the documents with ``least_words`` are drawn.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    scored = weighed(docs, target, **options).withColumn(
        "score", F.col("weight") + gumbel("id", seed)
    )
    scored = scratch.store(scored, "scored")
    long_enough = F.col("n_words") >= least_words
    drawn = scored.filter(long_enough).count() * share // 100
    numbered = range_numbered(
        scratch,
        scored.filter(long_enough),
        [F.desc("score"), F.asc_nulls_last("id"), "n_features", "weight"],
        "rank",
    )
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return numbered.withColumn("rank", rank).unionByName(rest)
