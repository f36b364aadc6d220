"""SimHash near-deduplication with pigeonring filtering.

A fingerprint's 64 bits are laid out as a ring of m segments.  If two of them
differ in at most tau bits, some segment starts a chain in which, for every l,
the first l consecutive segments differ in at most l * tau / m bits.  Since these
budgets are integers, such a chain must hold several segments without any
difference; the patterns of segments that can be free of differences are the
index keys (``chain_patterns``).  Inside a bucket of equal keys the chain is
followed segment by segment and a pair is dropped as soon as it exceeds its
budget; the last step of the chain is the full Hamming check.  No pair within
tau is lost, whatever m is; m only trades the number of keys for their width, so
it is taken from the number of fingerprints.

A bucket that is too large for one task is cut into blocks, and each pair of
blocks becomes a group of its own: memory stays bounded and no row is dropped.

``simhash_components`` links equal or close fingerprints; a bucket reports a
spanning forest of its links rather than all pairs, which has the same
components.

``near_duplicates`` links documents whose five-word shingles have a Jaccard
similarity of at least 0.8, and loses none of these links.  Equal sets of
shingles are one node.  The shingles of a set are put in one order for all sets,
rare ones first; two sets as similar as that must share one of the first
``prefix_length``.  Only nodes with such a shared shingle, and only their shared
shingles, go on.  Three kinds of rounds follow, each of which checks its pairs
exactly and joins what is linked into one part:

1. close fingerprints of the distinct words, each node against its closest
   candidates inside one block;
2. ``STARS`` times, each node against ``HUBS`` hubs of the largest parts that share
   a shingle with it, so at most ``HUBS`` pairs a node;
3. all pairs that share a shingle, are in different parts by then and pass the
   bounds by size and position.

Before texts are read again, a pair must pass a bound from sketches: with shingles
counted by hash slot, two sets share at most the sum of the lesser counts.

The first two join most of a large group with few pairs, the last one is exact; the
pairs it makes grow with those left apart times the size of the group.  Which
shingles count as common is taken from a sample; it decides how many pairs are
checked, not which are found.

Defined results: a null text counts as empty; a text of fewer words than a
shingle is one shingle; a text without words has fingerprint zero (in
``near_duplicates`` an empty shingle) and is linked like any other; rows with a
null id get a fingerprint, and the component's smallest id that isn't null.
``near_duplicates`` leaves rows with a null id alone; an id that repeats with
different texts has a row for each component they are in.  An empty table gives
no rows.  ``without_near_copies`` decides by row, those with a null id included.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.common import Scratch, fields, passing, with_row_key, without_rows, words
from clickstrata.llm.components import connected_components

BITS = 64
BLOCK = 512  # most rows of a bucket that one group takes from each side
PAIRS = 200_000  # pairs that are followed at once
MEMBER = ("fp", "node", "block")
CLOSEST = 3  # candidates of a document in the first round, for each key
SLOTS = 256  # slots of a set's sketch, one byte each
STARS = 1  # rounds of nodes against hubs
HUBS = 2  # hubs that a node is checked against in such a round
SAMPLE = 16  # one document in so many is read to find common shingles
COMMON = 3  # documents of the sample that make a shingle common
MOST_COMMON = 500_000  # common shingles that are sent to the workers at most
EPS = 1e-9  # keeps rounding from tightening a bound
_hash = partial(xxhash.xxh64_intdigest, seed=42)


# --- fingerprints ---------------------------------------------------------------


def shingles(text: str | None, k: int) -> list[bytes]:
    """Space-joined runs of k words, repeats included; fewer words: one run."""
    found = words(text)
    if len(found) <= k:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*(found[i:] for i in range(k)), strict=False)))


def hashes(features: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, features), dtype=np.uint64, count=len(features))


def majority(hashed: np.ndarray) -> int:
    """Bits set in over half the hashes, as a signed 64-bit integer."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashed), 8192):
        octets = hashed[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = (2 * counts > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _of_shingles(k: int):
    @F.pandas_udf(T.LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: majority(hashes(shingles(text, k))))

    return fingerprint


# --- pigeonring index -------------------------------------------------------------


def segments(m: int) -> list[int]:
    """Masks of m segments of nearly equal width."""
    cuts = [i * BITS // m for i in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def budgets(tau: int, m: int) -> list[int]:
    return [length * tau // m for length in range(1, m + 1)]


def chain_patterns(tau: int, m: int) -> dict[frozenset[int], list[int]]:
    """Sets of m - tau segments free of differences -> the chain starts they serve."""
    allowed = budgets(tau, m)
    exact = m - tau
    length = next(n for n in range(1, m + 1) if n - allowed[n - 1] == exact)
    patterns: dict[frozenset[int], list[int]] = {}
    for offsets in combinations(range(length), exact):
        free = set(offsets)
        differing = np.cumsum([i not in free for i in range(length)])
        if any(differing[i] > allowed[i] for i in range(length)):
            continue
        for start in range(m):
            key = frozenset((start + i) % m for i in offsets)
            patterns.setdefault(key, []).append(start)
    return patterns


def segments_for(n: int, tau: int) -> int:
    """Enough segments for keys about as wide as n distinct values need."""
    bits = math.log2(max(n, 2)) - 4
    for m in range(tau + 2, BITS + 1):
        if (m - tau) * BITS / m >= bits:
            return m
    return BITS


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def follow_chains(
    values: np.ndarray, left: np.ndarray, right: np.ndarray, tau: int, m: int, starts
) -> np.ndarray:
    """Which pairs (left, right) keep within the budgets of a chain to its end."""
    masks, allowed = [np.uint64(x) for x in segments(m)], budgets(tau, m)
    differ = values[left] ^ values[right]
    viable = np.zeros(len(left), dtype=bool)
    for start in starts:
        alive = np.flatnonzero(~viable)
        spent = np.zeros(len(alive), dtype=np.uint8)
        for step in range(m):
            mask = masks[(start + step) % m]
            spent = spent + np.bitwise_count(differ[alive] & mask)
            within = spent <= allowed[step]
            alive, spent = alive[within], spent[within]
        viable[alive] = True
    return viable


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions is linked to."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        np.minimum.at(label, right, label[left])
        label = label[label]
        if (label == before).all():
            return label


def _closest(differ: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of the pairs, those that are among the closest of either member."""
    ends = np.concatenate([left, right])
    pair = np.tile(np.arange(len(left)), 2)
    order = np.lexsort((pair, differ[pair], ends))
    ends, pair = ends[order], pair[order]
    rank = np.arange(len(ends)) - np.searchsorted(ends, ends)
    return np.unique(pair[rank < CLOSEST])


def _pairs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs inside consecutive groups of these sizes, in parts."""
    end = np.repeat(np.cumsum(sizes), sizes)
    left = np.arange(len(end))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    shift = total = 0
    while len(left):
        shift += 1
        left = left[left + shift < end[left]]
        held.append((left, left + shift))
        total += len(left)
        if total >= PAIRS or not len(left):
            yield (
                np.concatenate([x for x, _ in held]),
                np.concatenate([x for _, x in held]),
            )
            held, total = [], 0


def _bucket_links(tau: int, m: int, report: str):
    """Links of groups of bucket members, as (a, b) of their nodes."""
    patterns = list(chain_patterns(tau, m).values())

    def of(groups: pd.DataFrame, starts: list[int]) -> np.ndarray:
        flat = {c: np.concatenate(groups[c].to_list()) for c in MEMBER}
        values = flat["fp"].astype(np.uint64)
        inner = np.repeat((groups["lo"] == groups["hi"]).to_numpy(), groups["n"])
        links = []
        for left, right in _pairs(groups["n"].to_numpy()):
            # A pair inside one block belongs to that block's own group.
            keep = inner[left] | (flat["block"][left] != flat["block"][right])
            keep &= flat["node"][left] != flat["node"][right]
            left, right = left[keep], right[keep]
            keep = follow_chains(values, left, right, tau, m, starts)
            links.append(np.stack([left[keep], right[keep]]))
        left, right = np.concatenate(links, axis=1)
        if report == "forest" and len(left):
            label = _forest(len(values), left, right)
            left = np.flatnonzero(label != np.arange(len(label)))
            right = label[left]
        elif report == "closest" and len(left):
            keep = _closest(np.bitwise_count(values[left] ^ values[right]), left, right)
            left, right = left[keep], right[keep]
        return np.sort(flat["node"][np.stack([left, right])], axis=0)

    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["n"] = frame["fp"].map(len)
            for pattern, groups in frame.groupby("pattern"):
                a, b = of(groups, patterns[pattern])
                yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return links


def _cells(keyed: DataFrame, keys: list[str], members: list[str], across: bool):
    """Groups of rows (keys, n, members) of equal keys, n rows to a key in all.

    Each pair of a key's blocks is a group (lo, hi), or each block if not ``across``.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    others = F.expr("sequence(0, blocks - 1)") if across else F.array("block")
    return (
        keyed.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", *keys), "blocks").cast("int"))
        .withColumn("other", F.explode(others))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .withColumn("cell", F.xxhash64(*keys, "lo", "hi"))
        .repartition("cell")
        .groupBy("cell", *keys, "lo", "hi")
        .agg(*[F.collect_list(c).alias(c) for c in members])
        .filter(F.size("node") > 1)
    )


def close_pairs(nodes: DataFrame, tau: int, report: str, n: int) -> DataFrame:
    """Links (a, b) between nodes (node, fp) whose fingerprints are close.

    ``report``: "forest" spans each bucket's components, "closest" gives each
    node's closest partners in its block.
    """
    m = segments_for(n, tau)
    masks = segments(m)
    keys = [
        F.struct(
            F.lit(i).alias("pattern"),
            F.col("fp")
            .bitwiseAND(F.lit(_signed(sum(masks[s] for s in pattern))))
            .alias("value"),
        )
        for i, pattern in enumerate(chain_patterns(tau, m))
    ]
    keyed = nodes.select("node", "fp", F.explode(F.array(*keys)).alias("key"))
    keyed = keyed.select("node", "fp", "key.pattern", "key.value")
    sizes = keyed.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n"))
    keyed = keyed.join(sizes.filter("n > 1"), ["pattern", "value"])
    cells = _cells(keyed, ["pattern", "value"], list(MEMBER), report == "forest")
    cells = cells.select("pattern", "lo", "hi", *MEMBER)
    return cells.mapInPandas(_bucket_links(tau, m, report), "a long, b long").distinct()


# --- operators --------------------------------------------------------------------


def simhash_components(
    docs: DataFrame,
    k: int = 3,
    tau: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fp, component_id): fingerprints of k-word shingles, linked within tau."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = docs.select(
        F.col(id_col).alias("id"),
        _of_shingles(k)(F.col(text_col).cast("string")).alias("fp"),
    )
    prints = scratch.store(prints, "prints")
    reps = scratch.store(prints.groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    nodes = reps.select(F.col("fp").alias("node"), "fp")
    links = close_pairs(nodes, tau, "forest", reps.count())
    rooted = connected_components(links)
    rooted = reps.join(rooted, reps["fp"] == rooted["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = scratch.store(rooted.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def shingle_set(text: str | None) -> np.ndarray:
    """Hashes of the five-word shingles, each once and in order."""
    return np.unique(hashes(shingles(text, 5) or [b""]))


@F.pandas_udf(T.BinaryType())
def _shingle_set(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: shingle_set(text).tobytes())


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingle_list(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: shingle_set(text).view(np.int64))


@F.pandas_udf(T.DoubleType())
def _jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
    def of(a: bytes, b: bytes) -> float:
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both / (len(x) + len(y) - both)

    return pd.Series([of(a, b) for a, b in zip(left, right, strict=True)])


def sketch(found: np.ndarray) -> bytes:
    """How many shingles of a set fall into each slot; 255 stands for any more."""
    counts = np.bincount((found % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_be_similar(x: bytes, y: bytes, sizes: int, similarity: float) -> bool:
    """False only if the sketches of two sets, ``sizes`` in all, rule it out."""
    both = np.minimum(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
    if both.max() == 255:  # counts that aren't known
        return True
    return int(both.sum(dtype=np.int64)) >= similarity / (1 + similarity) * sizes - EPS


def _may_be_similar(similarity: float):
    @F.pandas_udf(T.BooleanType())
    def passes(x: pd.Series, y: pd.Series, sizes: pd.Series) -> pd.Series:
        pairs = zip(x, y, sizes, strict=True)
        return pd.Series([may_be_similar(*pair, similarity) for pair in pairs], dtype=bool)

    return passes


def prefix_length(size: int, similarity: float) -> int:
    """Shingles of which a set shares one with each set as similar as that."""
    return size - math.ceil(similarity * size - EPS) + 1


def prefix(found: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float):
    """The first shingles of a sorted set: rare before common, then by hash."""
    n = prefix_length(len(found), similarity)
    if not len(common):
        return found[:n]
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    rank = np.where(common[at] == found, counts[at], 0)
    return found[np.lexsort((found, rank))[:n]]


def common_shingles(texts: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that are common in the sample (row, text), with their counts."""
    sample = texts.filter(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0)
    counted = sample.select(F.explode(_shingle_list("text")).alias("shingle"))
    counted = counted.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counted = scratch.store(counted.filter(F.col("n") >= COMMON), "common")
    # One row per count that occurs; the rarest are left out if there are too many.
    held, least = 0, COMMON
    for n, many in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):
        held += many
        if held > MOST_COMMON:
            least = n + 1
            break
    found = counted.filter(F.col("n") >= least).toPandas().astype(np.int64)
    keys = found["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["n"].to_numpy()[order]


def _signatures(spark, common: tuple[np.ndarray, np.ndarray], similarity: float):
    shared = spark.sparkContext.broadcast(common)

    @F.pandas_udf("fp long, digest binary, size int, sketch binary, prefix array<long>")
    def signature(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shingle_set(text)
            rows.append(
                (
                    majority(hashes(list(set(words(text))))),
                    hashlib.md5(found.tobytes()).digest(),
                    len(found),
                    sketch(found),
                    prefix(found, *shared.value, similarity).view(np.int64),
                )
            )
        return pd.DataFrame(rows, columns=["fp", "digest", "size", "sketch", "prefix"])

    return signature


SHARING = ["node", "part", "size", "at", "block"]


def _sharing_pairs(similarity: float):
    """Pairs of groups that share a shingle, cross parts and may be similar."""

    def of(groups: pd.DataFrame) -> np.ndarray:
        flat = {c: np.concatenate(groups[c].to_list()) for c in SHARING}
        inner = np.repeat((groups["lo"] == groups["hi"]).to_numpy(), groups["n"])
        pairs = []
        for left, right in _pairs(groups["n"].to_numpy()):
            keep = inner[left] | (flat["block"][left] != flat["block"][right])
            keep &= flat["part"][left] != flat["part"][right]
            left, right = left[keep], right[keep]
            x, y = flat["size"][left].astype(int), flat["size"][right].astype(int)
            keep = np.minimum(x, y) >= similarity * np.maximum(x, y) - EPS
            # At their first shared shingle, what follows it bounds what they share.
            rest = np.minimum(x - flat["at"][left], y - flat["at"][right])
            keep &= rest >= similarity / (1 + similarity) * (x + y) - EPS
            pairs.append(np.stack([left[keep], right[keep]]))
        return np.sort(flat["node"][np.concatenate(pairs, axis=1)], axis=0)

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["n"] = frame["node"].map(len)
            a, b = of(frame)
            yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return pairs


def sharing_pairs(entries: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) across parts that share a shingle and may be similar.

    Entries are (shingle, node, at, size, part) of shingles that several parts hold.
    """
    shared = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    cells = _cells(entries.join(shared, "shingle"), ["shingle"], SHARING, True)
    cells = cells.select("lo", "hi", *SHARING)
    return cells.mapInPandas(_sharing_pairs(similarity), "a long, b long").distinct()


def across_parts(entries: DataFrame, turn: int) -> DataFrame:
    """The entries of shingles that several parts hold, with a hub of the largest one.

    Hubs change with the turn: (shingle, node, at, size, part, top_part, hub, hub_at,
    hub_size).
    """
    draw = F.xxhash64("node", F.lit(turn))
    held = entries.groupBy("shingle", "part").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min_by(c, draw).alias(f"hub_{c}") for c in ("node", "at", "size")],
    )
    top = F.max(F.struct("n", F.col("part").alias("top_part"), "hub_node", "hub_at", "hub_size"))
    hubs = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("parts"), top.alias("top"))
    hubs = hubs.filter("parts > 1").select("shingle", "top.*").drop("n")
    return entries.join(hubs.withColumnRenamed("hub_node", "hub"), "shingle")


def star_pairs(entries: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of a node with the hubs of other parts that share most with it."""
    both = F.col("size") + F.col("hub_size")
    rest = F.least(F.col("size") - F.col("at"), F.col("hub_size") - F.col("hub_at"))
    least, most = F.least("size", "hub_size"), F.greatest("size", "hub_size")
    votes = (
        entries.filter("part != top_part")
        .filter(least >= similarity * most - EPS)
        .groupBy("node", "hub")
        # What follows their first shared shingle bounds what they share.
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(rest - similarity / (1 + similarity) * both).alias("slack"),
        )
        .filter(F.col("slack") >= -EPS)
    )
    order = W.partitionBy("node").orderBy(F.desc("n"), "hub")
    chosen = votes.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= HUBS)
    return chosen.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def near_groups(
    rows: DataFrame, scratch: Scratch, tau: int = 7, similarity: float = 0.8
) -> DataFrame:
    """(id, row, group) of rows (id, row, text); near copies are in one group.

    Rows of equal ``row`` must have equal texts.  What is stored on the way goes as
    soon as it has been read.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("key", F.concat("row", F.coalesce(F.col("id").cast("string"), F.lit("-"))))
    common = common_shingles(rows, scratch)
    signature = _signatures(spark, common, similarity)
    prints = keyed.select("id", "row", "key", signature("text").alias("s"))
    prints = scratch.store(prints.select("id", "row", "key", "s.*"), "prints")
    scratch.drop("common")
    # Numbered once and stored: a node is a set of shingles.
    nodes = prints.groupBy("digest").agg(
        *[F.min(c).alias(c) for c in ("fp", "size", "sketch", "prefix", "key")]
    )
    nodes = nodes.withColumn("node", F.monotonically_increasing_id())
    nodes = scratch.store(nodes, "nodes")
    members = prints.select("id", "row", "digest").join(nodes.select("digest", "node"), "digest")
    members = scratch.store(members.drop("digest"), "members")
    scratch.drop("prints")

    entries = nodes.select("node", F.posexplode("prefix").alias("at", "shingle"))
    shared = entries.groupBy("shingle").agg(F.count(F.lit(1)).cast("int").alias("n"))
    shared = scratch.store(shared.filter("n > 1").select("shingle"), "shared")
    entries = scratch.store(entries.join(shared, "shingle", "left_semi"), "entries-0")
    sharing = scratch.store(entries.select("node").distinct(), "sharing")
    candidates = nodes.select("node", "key", "fp", "size", "sketch").join(sharing, "node")
    candidates = scratch.store(candidates, "candidates")
    scratch.drop("nodes", "shared", "sharing")
    sizes = candidates.select("node", "size")
    sketches = candidates.select("node", "size", "sketch")
    possible = _may_be_similar(similarity)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.join(sketches.toDF("a", "m", "x"), "a").join(sketches.toDF("b", "n", "y"), "b")
        least, most = F.least("m", "n"), F.greatest("m", "n")
        pairs = pairs.filter(least >= similarity * most - EPS)
        pairs = pairs.filter(possible("x", "y", F.col("m") + F.col("n"))).select("a", "b")
        pairs = scratch.store(pairs, f"{name}-pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ends = scratch.store(candidates.select("node", "key").join(ends, "node"), f"{name}-ends")
        texts = keyed.select("key", "text").join(ends, "key").dropDuplicates(["key"])
        sets = texts.select("node", _shingle_set("text").alias("set"))
        sets = scratch.store(sets, f"{name}-sets")
        found = scratch.store(
            pairs.join(sets.toDF("a", "x"), "a")
            .join(sets.toDF("b", "y"), "b")
            .filter(_jaccard("x", "y") >= similarity)
            .select("a", "b"),
            name,
        )
        scratch.drop(f"{name}-pairs", f"{name}-ends", f"{name}-sets")
        return found

    def parts_of(links: DataFrame, name: str) -> DataFrame:
        return scratch.store(connected_components(links), name)

    prints = candidates.select("node", "fp")
    links = confirmed(close_pairs(prints, tau, "closest", candidates.count()), "near")
    own = F.coalesce("root", "node").alias("part")
    entries = entries.join(sizes, "node")
    columns = ["shingle", "node", "at", "size"]
    for turn in range(STARS + 1):
        rooted = parts_of(links, f"rooted-{turn}")
        placed = entries.join(rooted, "node", "left").select(*columns, own)
        placed = scratch.store(placed, f"placed-{turn}")
        spread = scratch.store(across_parts(placed, turn), f"entries-{turn + 1}")
        scratch.drop(f"rooted-{turn}", f"placed-{turn}", f"entries-{turn}")
        if turn < STARS:
            links = links.union(confirmed(star_pairs(spread, similarity), f"star-{turn}"))
        entries = spread.select(*columns)
    links = links.union(confirmed(sharing_pairs(spread.select(*columns, "part"), similarity), "rest"))
    rooted = parts_of(links, "rooted")
    group = F.coalesce("root", "node").alias("group")
    groups = members.join(rooted, "node", "left").select("id", "row", group)
    return scratch.store(groups, "groups")


def near_duplicates(
    docs: DataFrame,
    tau: int = 7,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, component_id) of documents that have a near copy."""
    spark = docs.sparkSession
    kept = Scratch(spark, "near-duplicates")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("row"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("id is not null")
    with passing(spark):
        scratch = Scratch(spark, "near-duplicates-rows")
        found = near_groups(rows, scratch, tau, similarity).select("id", "group")
        least = found.groupBy("group").agg(
            F.min("id").alias("component_id"), F.max("id").alias("m")
        )
        least = least.filter("component_id < m").drop("m")
        named = found.join(least, "group").select("id", "component_id").distinct()
        return kept.store(named, "named")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, nulls last."""
    spark = docs.sparkSession
    kept = Scratch(spark, "near-duplicates")
    keyed = with_row_key(docs)
    with passing(spark):
        scratch = Scratch(spark, "near-duplicates-rows")
        rows = fields(keyed, "doc_id", "text").select(
            F.col("doc_id").cast("long").alias("id"), "row", F.col("text").cast("string")
        )
        found = near_groups(rows, scratch)
        order = F.struct(F.isnull("id"), "id", "row")
        best = found.groupBy("group").agg(
            F.min(order).alias("best"), F.count(F.lit(1)).alias("n")
        )
        best = scratch.store(best.filter("n > 1").select("group", "best.row"), "best")
        several = found.join(best.withColumnRenamed("row", "best"), "group")
        gone = several.filter("row != best").select("row").distinct()
        twins = several.filter("row = best").groupBy("row").count().filter("count > 1")
        gone = kept.store(gone, "gone")
        twins = kept.store(twins.select("row"), "twins")
    return without_rows(keyed, gone, twins)
