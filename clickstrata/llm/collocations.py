"""Phrase collocations counted in a prefix-free parse of the corpus.

A text becomes a row of tokens: lower-cased words, and one break between pieces.
Wherever the hash of a window of w = ``longest`` - 1 tokens is divisible by
``EVERY`` the row is cut, so that passages that documents share are cut alike.  A
chunk runs from one such window to the end of the next; neighbours overlap by w
tokens, and w breaks close the text.  The distinct chunks with their frequencies
are the dictionary of the parse: a passage that a third of all documents repeat is
looked into once, with its frequency as weight.

A run of up to ``longest`` words belongs to the chunk in which it begins before
the last w tokens, and lies wholly inside it; so every occurrence counts once.

1. Chunks are counted inside a task, then over all tasks.
2. Runs of 1, 2, ... words are counted in the dictionary, one length after the
   other.  Only runs can matter whose both shorter runs reach ``least``; those that
   do are known to the next length by a bitmap of ``BITS`` hashed bits, which may
   let others through but stops none.  As its size is fixed, it is broadcast.
3. A candidate's cuts look up their parts' counts; the lowest score counts.
   Candidates inside a longer one of at least ``within`` percent of their count
   are dropped.  A range sort numbers the others, and the first ``top`` of each
   language stay.

Defined results: a null text is empty, a null language is ``unknown_lang``; a text
without words counts nothing; ties in score go to the larger count, then to the
smaller phrase by its bytes; a chunk ends after ``CHUNK`` tokens at the latest, so
a text of one repeated word is cut too; an empty table gives no rows.  Scores are
exact for counts up to 10^15.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm.common import LOWER, UPPER, Scratch, entries, range_numbered

# Fixed value: what parts pieces; blanks and tabs part words.
PIECES = b".,;:!?\x0A\x0B\x0C\x0D"
BREAK = b"."  # no word can be one
_FOLD = bytes.maketrans(UPPER.encode() + PIECES, LOWER.encode() + BREAK * len(PIECES))
_EMPTY = re.compile(rb"\.[ \t.]*\.")  # nothing but empty pieces
EVERY = 16
CHUNK = 4096
BITS = 1 << 26
HELD = 200_000  # chunks a task counts before it sends them on
AT_ONCE = 8 << 20  # bytes of the dictionary that a task looks into at once
SCALE = 1_000_000
SALTS = 16
FACTOR, MASK = 1_000_003, (1 << 32) - 1

CHUNKS = "lang string, chunk string, n long"


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words with a break between pieces."""
    parted = _EMPTY.sub(BREAK, (text or "").encode().translate(_FOLD))
    return parted.replace(BREAK, b" . ").split()


class _Hashes:
    """The hash of each token; words are short, so that looking it up takes longer."""

    __getitem__ = staticmethod(zlib.crc32)


def chunks(row: list[bytes], w: int, hashes: _Hashes, every: int = EVERY) -> Iterator[bytes]:
    """The chunks of a text, the last w tokens of each being the next one's first."""
    n = len(row)
    row = row + [BREAK] * w
    of = np.fromiter(map(hashes.__getitem__, row), np.int64, len(row))
    window = np.zeros(n + 1, np.int64)
    for i in range(w):
        window = window * FACTOR + of[i : i + n + 1] & MASK
    # Low bits of a CRC of short words are uneven; the product's middle ones aren't.
    cuts = np.nonzero((window * FACTOR >> 8) % every == 0)[0].tolist()
    start = 0
    for cut in [*cuts, n]:
        while cut - start > CHUNK:
            yield b" ".join(row[start : start + CHUNK + w])
            start += CHUNK
        if cut > start:
            yield b" ".join(row[start : cut + w])
            start = cut


def _parsing(w: int, every: int) -> Callable:
    def send(counts: Counter) -> pa.RecordBatch:
        lang, chunk = zip(*counts, strict=True)
        columns = [
            pa.array(lang, pa.string()),
            pa.array(chunk, pa.binary()).cast(pa.string()),
            pa.array(counts.values(), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "n"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        hashes = _Hashes()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang, text in zip(langs, batch.column("text"), strict=True):
                row = tokens(text.as_py())
                counts.update((lang, chunk) for chunk in chunks(row, w, hashes, every))
                if len(counts) >= HELD:
                    yield send(counts)
                    counts = Counter()
        if counts:
            yield send(counts)

    return parse


def runs(table: pa.Table, n: int, w: int, filters: list[np.ndarray]) -> pa.Table:
    """(lang, phrase, n) of the runs of n words in a piece of the dictionary.

    ``filters`` holds the bitmaps of the runs of 1, 2, ... n - 1 words.
    """
    split = pc.split_pattern(table["chunk"].combine_chunks().cast(pa.binary()), b" ")
    length = pc.list_value_length(split).to_numpy()
    encoded = pc.list_flatten(split).dictionary_encode()
    word = encoded.indices.to_numpy().astype(np.int64)
    spelled = encoded.dictionary
    crc = np.array([zlib.crc32(x) for x in entries(spelled)], np.int64)[word]
    chunk = np.repeat(np.arange(len(length)), length)
    ends = np.cumsum(length)
    # Where a run may begin: a word before the last w tokens of its chunk.
    usable = word != (spelled.index(pa.scalar(BREAK, spelled.type)).as_py())
    begins = usable & (np.arange(len(word)) < (ends - w)[chunk])

    run, hashed = word, crc
    for m in range(1, n):
        bits = filters[m - 1]
        place = hashed % BITS
        usable = usable & (bits[place >> 3] >> (place & 7) & 1).astype(bool)
        # Both runs of m words inside one of m + 1 have to be usable.
        usable = usable[:-1] & usable[1:]
        codes = run[:-1] * len(word) + run[1:]
        if m == n - 1:  # no longer run is made of these
            run = codes
            break
        run = np.zeros(len(codes), np.int64)
        run[usable] = pd.factorize(codes[usable])[0]
        hashed = (hashed[:-1] * FACTOR + crc[m:]) & MASK
    at = np.nonzero(usable & begins[: len(usable)])[0]

    langs = table["lang"].combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy()[chunk[at]]
    # A run of two words is the code of a pair, too large beside very many languages.
    if len(langs.dictionary) * len(word) ** 2 >= 1 << 63:
        run = pd.factorize(run)[0]
    code = run[at] * max(len(langs.dictionary), 1) + lang
    inverse, distinct = pd.factorize(code)
    first = np.zeros(len(distinct), np.int64)
    first[inverse[::-1]] = np.arange(len(code))[::-1]
    weights = table["n"].to_numpy()[chunk[at]]
    counts = np.zeros(len(first), np.int64)
    np.add.at(counts, inverse, weights)
    head = at[first]
    parts = [spelled.take(pa.array(word[head + i])) for i in range(n)]
    phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", spelled.type)) if n > 1 else parts[0]
    return pa.table(
        {
            "lang": langs.dictionary.take(pa.array(lang[first])),
            "phrase": phrase.cast(pa.string()),
            "n": pa.array(counts),
        }
    )


def _looking(n: int, w: int, filters: list) -> Callable:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(f.value, np.uint8) for f in filters]
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= AT_ONCE:
                yield from runs(pa.Table.from_batches(held), n, w, maps).to_batches()
                held, size = [], 0
        if held:
            yield from runs(pa.Table.from_batches(held), n, w, maps).to_batches()

    return look


def _hash(phrase: Column) -> Column:
    """The hash of a run from those of its words, as ``runs`` forms it."""
    return F.aggregate(
        F.split(phrase, " "),
        F.lit(0).cast("long"),
        lambda h, word: (h * FACTOR + F.crc32(word)).bitwiseAND(F.lit(MASK)),
    )


def _bitmap(spark: SparkSession, phrases: DataFrame):
    """A broadcast bitmap of the phrases' hashes: at most BITS / 64 longs are read."""
    place = phrases.select(F.pmod(_hash(F.col("phrase")), F.lit(BITS)).alias("place"))
    longs = place.groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    found = longs.toArrow()
    bits = np.zeros(BITS // 64, "<i8")
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return spark.sparkContext.broadcast(bits.tobytes())


def parse(
    docs: DataFrame,
    longest: int = 3,
    every: int = EVERY,
    text_col: str = "text",
    lang_col: str = "lang",
    unknown_lang: str = "und",
) -> DataFrame:
    """(lang, chunk, n): the dictionary of the parse with its frequencies."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(unknown_lang)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    parsed = rows.mapInArrow(_parsing(longest - 1, every), CHUNKS)
    return parsed.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    within: int = 50,
    top: int = 2000,
    **options,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    dictionary = scratch.store(parse(docs, longest, **options), "dictionary")

    filters: list = []
    levels: list[DataFrame] = []
    totals = None
    for n in range(1, longest + 1):
        found = dictionary.mapInArrow(
            _looking(n, longest - 1, filters), "lang string, phrase string, n long"
        )
        counted = found.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        if n == 1:
            counted = scratch.store(counted, "words")
            totals = scratch.store(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
        frequent = counted.filter(F.col("f") >= least)
        frequent = scratch.store(frequent.withColumn("words", F.lit(n)), f"frequent-{n}")
        if n == 1:
            scratch.drop("words")
        levels.append(frequent)
        if n < longest:
            filters.append(_bitmap(spark, frequent))
    scratch.drop("dictionary")
    for bitmap in filters:
        bitmap.unpersist()

    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    candidates = counts.filter("words > 1")
    scored = _scored(candidates, counts, scratch)
    longer = _longer(candidates.filter("words > 2"))
    kept = (
        scored.join(longer, ["lang", "phrase"], "left")
        .filter(F.coalesce(F.lit(100) * F.col("longer") < F.lit(within) * F.col("a"), F.lit(True)))
        .drop("longer")
    )
    # Numbered by a range sort: a language's candidates would fill one window task.
    kept = scratch.store(kept, "kept")
    order = ["lang", F.desc("score"), F.desc("a"), "phrase"]
    placed = range_numbered(scratch, kept, order, "place")
    firsts = scratch.store(placed.groupBy("lang").agg(F.min("place").alias("first")), "firsts")
    rank = (F.col("place") - F.col("first") + 1).alias("rank")
    ranked = placed.join(firsts, "lang").select("*", rank).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("tokens", first, length), " ")


def _scored(candidates: DataFrame, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, phrase, a, l, r, score) by each candidate's lowest cut.

    A word as common as an article is looked up by very many candidates, so the
    words' counts are repeated for ``SALTS`` salts, over which the candidates spread.
    """
    cuts = (
        candidates.withColumn("tokens", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang",
            "phrase",
            F.col("f").alias("a"),
            "k",
            _part(F.lit(1), F.col("k")).alias("left"),
            _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
            (F.col("words") - F.col("k")).alias("rest"),
        )
    )
    last = F.when(F.col("words") == 1, SALTS - 1).otherwise(0)
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), last)))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    for side, name, length in (("left", "l", "k"), ("right", "r", "rest")):
        of = salted.select("lang", F.col("phrase").alias(side), "salt", F.col("f").alias(name))
        cuts = cuts.withColumn("salt", F.when(F.col(length) == 1, salt).otherwise(0))
        cuts = cuts.join(of, ["lang", side, "salt"]).drop("salt")
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    score = F.expr(f"cast((cast({SCALE} as decimal(7,0)) * ({a} * {a})) div ({l} * {r}) as long)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer candidate around a phrase."""
    inner = (
        candidates.withColumn("tokens", F.split("phrase", " "))
        .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
        .select("lang", _part(F.col("at"), F.col("length")).alias("phrase"), "f")
    )
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
