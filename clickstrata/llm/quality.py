"""Quality classifier: an interpolated modified Kneser-Ney trigram model.

The model is fitted on all trusted documents (quality 1, not toxic) but the share
``HELD_OUT``, drawn by hash of the id, that the limits are taken from.

Every place of a text is a trigram, and is dealt to a shard by its middle word, so
that a shard has the counts of its trigrams, of both their bigrams and of the middle
words as contexts.  A middle word that fills more than a part of a shard is split by
the word before it; the counts of its bigrams are then summed over its shards and
handed back to them.  Only continuation counts of words are needed everywhere: they
are counted in shards of their own, which each shard asks for the words it has.

Fitting (``train``) counts the trusted places and gives discounts and words.  Scoring
counts them again, beside all other places of the shard, and returns each text's sum
of logarithms, so no n-gram is stored or sent by itself.  Shards are worked off in
``ROUNDS``, for each of which the texts, stored with their labels, are read again:
what is in shuffles at once is only a round's places, packed.

A second model of the same kind is fitted on all documents labelled toxic or junk.
The quotient of the two perplexities says how much better it foretells a text than
the first model does; as a few toxic words drown in the mean of a long text, the
largest quotient of a single word's shares counts too.

A document is accepted if its perplexity and these two quotients are each at most
the ``QUANTILE`` of its language among the trusted documents that were held out;
without toxic or junk labels only the perplexity counts.  The quantiles come from
exact counts in bins of a thousandth of the logarithm.

Defined results: a null text is empty and consists of the end of the text; a
language without held-out documents takes the quantile of all languages, and
without any held-out document everything is accepted; several labels of one id
are trusted only if all are; labels with nulls are not; an empty table gives no
rows.  The documents are read once for each of ``SHARES`` and must read the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.llm.common import (
    Scratch,
    batches,
    fields,
    folded,
    passing,
    with_row_key,
)

HELD_OUT = 0.1  # share of trusted documents kept for the thresholds
QUANTILE = 0.995
BIN = 1000  # bins per unit of log perplexity
TEXT_BYTES = 1 << 18  # text hashed at once, within a processor's cache
LONG = 64  # bytes of a word that is hashed by itself
BLOCK = 1 << 10  # rows dealt to shards at once
ROUNDS = 10  # parts in which the shards are worked off
SHARES = 4  # parts in which the texts are joined with their labels
SHARD = 1 << 20  # places in a shard
ASKED = 1 << 21  # words a task collects before it asks for them
FIXED = 32  # bits of a logarithm after the point; such sums don't depend on the order

START, END = np.uint64(0x5BD1E995A7C3F10D), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = bytes(int(x in (0x20, *range(0x09, 0x0E))) for x in range(256))
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # the first bytes


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _MIX
    return keys ^ (keys >> np.uint64(29))


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Key of an n-gram from that of its head and of its last word."""
    mixed = (first ^ (first >> np.uint64(29))) * _MIX + second
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words in a row, and how many each text has.

    Words are hashed by eight bytes at once, all words together; long ones by
    themselves.
    """
    raw = b"".join(x for t in texts for x in (t, b" ")) + bytes(8)
    blank = np.frombuffer(raw.translate(_BLANK), np.int8)[:-8]
    edges = np.diff(blank, prepend=np.int8(1))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    eights = np.ndarray(len(blank), "<u8", raw, strides=(1,))  # from each byte on
    lengths = ends - starts
    keys = _joined(lengths.astype(np.uint64), eights[starts] & _KEEP[np.minimum(lengths, 8)])
    rest = np.flatnonzero(lengths > 8)
    for at in range(8, LONG, 8):
        if not len(rest):
            break
        piece = eights[starts[rest] + at] & _KEEP[np.minimum(lengths[rest] - at, 8)]
        keys[rest] = _joined(keys[rest], piece)
        rest = rest[lengths[rest] > at + 8]
    for i in rest.tolist():
        keys[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]])
    after = np.cumsum([len(t) + 1 for t in texts])
    return _mixed(keys), np.diff(np.searchsorted(starts, after), prepend=0)


def places(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Each place's two words before it, its word and the number of its text; a text
    has two starts before and an end after it, which is a place."""
    found, before = [], 0
    for part in batches(map(folded, texts), TEXT_BYTES, len):
        keys, counts = word_keys(part)
        at = np.cumsum(counts + 3) - counts - 3  # of each text's first start
        tokens = np.full(len(keys) + 3 * len(part), START)
        of = np.repeat(np.arange(len(part)), counts)
        tokens[np.arange(len(keys)) + 3 * of + 2] = keys
        tokens[at + counts + 2] = END
        predicted = np.ones(len(tokens), bool)
        predicted[at] = predicted[at + 1] = False
        predicted = np.flatnonzero(predicted)
        doc = np.repeat(np.arange(len(part)), counts + 1) + before
        found.append((tokens[predicted - 2], tokens[predicted - 1], tokens[predicted], doc))
        before += len(part)
    if not found:
        return (*(np.zeros(0, np.uint64),) * 3, np.zeros(0, np.int64))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


def unpacked(n: int, body: bytes, *types: str) -> list[np.ndarray]:
    """The arrays of ``n`` values each that were packed together."""
    ends = np.cumsum([0, *(n * np.dtype(t).itemsize for t in types)]).tolist()
    raw = pa.decompress(body, decompressed_size=ends[-1], codec="zstd", asbytes=True)
    return [np.frombuffer(raw, t, n, a) for t, a in zip(types, ends, strict=False)]


def _all_unpacked(frame: pd.DataFrame, *types: str) -> list[np.ndarray]:
    """The packed arrays of all rows (n, body), one after another."""
    rows = [unpacked(n, b, *types) for n, b in zip(frame["n"], frame["body"], strict=True)]
    if not rows:
        return [np.zeros(0, t) for t in types]
    return [np.concatenate(x) for x in zip(*rows, strict=True)]


def _dealt(to: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """Each shard in ``to`` and what is dealt to it, in the order it came."""
    if not len(to):
        return
    # Small whole numbers are sorted by digits.
    order = np.argsort(to.astype(np.uint16) if to.max() < 1 << 16 else to, kind="stable")
    to = to[order]
    arrays = [a[order] for a in arrays]
    starts = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to)).tolist()
    for a, b in zip(starts, starts[1:], strict=False):
        yield int(to[a]), *(x[a:b] for x in arrays)


@dataclass(frozen=True)
class Layout:
    """How places are dealt to shards, and where what is between steps goes."""

    scratch: Scratch = field(repr=False)
    shards: int
    rounds: int
    hot: np.ndarray  # sorted keys of middle words that are split
    parts: np.ndarray  # into how many

    def deal(self) -> tuple:
        """What workers need to deal places."""
        return self.shards, self.hot, self.parts


def _shard(deal: tuple, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    shards, hot, parts = deal
    key = w2
    if len(hot):
        at = np.minimum(np.searchsorted(hot, w2), len(hot) - 1)
        split = np.flatnonzero(hot[at] == w2)
        key = w2.copy()
        key[split] = _part(w2[split], _mixed(w1[split] + _MIX) % parts[at[split]])
    return _of_word(shards, key)


def _part(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    return _joined(words, part.astype(np.uint64) + np.uint64(1))


def _of_word(shards: int, words: np.ndarray) -> np.ndarray:
    return ((_mixed(words) >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)


def marked(rows: DataFrame, fits: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, fits, text) of all rows, stored; fits (id, fits) is 0 where there is none.

    The join is made for a share of the ids after the other, so that little of the
    texts is in shuffles at once.
    """
    fits = fits.filter("fits > 0")
    parts = []
    for i in range(SHARES):
        mine = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(SHARES)) == i
        part = rows.filter(mine).join(fits.filter(mine), "id", "left")
        part = part.select("a", "b", F.coalesce("fits", F.lit(0)).alias("fits"), "text")
        part.write.option("compression", "zstd").parquet(scratch.path(f"texts-{i}"))
        parts.append(scratch.path(f"texts-{i}"))
    return scratch.spark.read.schema(part.schema).parquet(*parts)


def laid_out(texts: DataFrame, scratch: Scratch) -> tuple[Layout, DataFrame]:
    """The layout for texts (a, b, text), and (a, b, copies, n_tokens) of each text."""

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            _, middle, _, doc = places(list(frame["text"]))
            n = np.bincount(doc, minlength=len(frame))
            yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "n": n, "hot": False})
            words, counts = np.unique(middle, return_counts=True)
            # What is rarer in all parts of the texts need not be split.
            often = counts * 4096 >= len(middle)
            words = words[often].view(np.int64)
            yield pd.DataFrame({"a": words, "b": 0, "n": counts[often], "hot": True})

    found = texts.select("a", "b", "text").mapInPandas(sizes, "a long, b long, n long, hot boolean")
    found = found.groupBy("a", "b", "hot").agg(
        F.max("n").alias("n_tokens"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    found = scratch.store(found, "sizes")
    total = found.filter("not hot").agg(F.sum("n")).first()[0] or 0
    most = max(SHARD // 4, 1)
    hot = {r["a"]: r["n"] for r in found.filter(F.col("hot") & (F.col("n") > most)).collect()}
    words = np.array(sorted(x % (1 << 64) for x in hot), np.uint64)
    parts = [-(-hot[x] // most) for x in words.view(np.int64).tolist()]
    shards = max(-(-total // SHARD), 1)
    rounds = min(ROUNDS, shards)
    layout = Layout(
        scratch, -(-shards // rounds) * rounds, rounds, words, np.array(parts, np.uint64)
    )
    return layout, found.filter("not hot").select("a", "b", "copies", "n_tokens")


@dataclass(frozen=True)
class Model:
    """What shards need of a model besides the places they have."""

    words: DataFrame  # (at, kind, n, body): continuation counts and split words' bigrams
    cuts: tuple[tuple[float, float, float], ...]  # discounts by order
    total: int  # of the words' counts
    floor: float  # share of each word, known or not, below the unigrams
    totals: np.ndarray  # of split words as contexts
    freed: np.ndarray

    def numbers(self) -> tuple:
        return self.cuts, self.total, self.floor, self.totals, self.freed


def _discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2, and 3 or more, from the counts of counts."""
    n = [0, *(counts.get(i, 0) for i in (1, 2, 3, 4))]
    if min(n[1:]) == 0:
        return 0.5, 0.75, 0.9  # too few n-grams to estimate them
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i) for i in (1, 2, 3))



def _cut(counts: np.ndarray, cuts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *cuts])[np.minimum(counts, 3).astype(np.int64)]


def _counts_of(counts: np.ndarray) -> dict[int, int]:
    """How many are 1, 2, 3, 4 and more."""
    found = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)
    return {i: int(found[i]) for i in range(1, 6)}


class Grams:
    """The distinct trigrams of places, and which bigrams they are made of."""

    def __init__(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray):
        key = _joined(_joined(w1, w2), w3)
        _, first, self.of = np.unique(key, return_index=True, return_inverse=True)
        w1, w2, self.last = w1[first], w2[first], w3[first]
        self.opens = w2 == START
        key, first, self.bigram = np.unique(
            _joined(w2, self.last), return_index=True, return_inverse=True
        )
        self.bigrams, self.heads, self.tails = key, w2[first], self.last[first]
        self.context = np.unique(_joined(w1, w2), return_inverse=True)[1]

    def bigram_counts(self, counts: np.ndarray) -> np.ndarray:
        """A bigram counts the words before it; what opens a text has nothing but
        starts before it and keeps its plain count."""
        return np.bincount(self.bigram, np.where(self.opens, counts, counts > 0)).astype(np.int64)


STATED = "kind string, key long, at int, n long, body binary"


def _row(kind: str, at: int, n: int, *arrays: np.ndarray, key: int = 0) -> tuple:
    return kind, key, at, n, packed(*arrays) if arrays else None


def train(texts: DataFrame, layout: Layout) -> Model:
    """Counts the texts' n-grams in shards, for the discounts and the words' counts."""
    scratch, deal = Scratch(layout.scratch.spark, "quality-counts"), layout.deal()
    rounds = max(layout.rounds // 5, 1)
    columns = ["kind", "key", "at", "n", "body"]

    def dealt(turn: int):
        def deal_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                w1, w2, w3, _ = places(list(frame["text"]))
                to = _shard(deal, w1, w2)
                mine = to % rounds == turn
                rows = [
                    (shard, len(x[0]), packed(*x))
                    for shard, *x in _dealt(to[mine], w1[mine], w2[mine], w3[mine])
                ]
                yield pd.DataFrame(rows, columns=["shard", "n", "body"])

        return deal_out

    def count(group: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(*_all_unpacked(group, "u8", "u8", "u8"))
        counts = np.bincount(grams.of)
        rows = [_row("three", i, n) for i, n in _counts_of(counts).items()]
        counts = grams.bigram_counts(counts)
        split = np.isin(grams.heads, deal[1])
        rows += [_row("two", i, n) for i, n in _counts_of(counts[~split]).items()]
        words, n = np.unique(grams.tails[~split], return_counts=True)
        for at, *x in _dealt(_of_word(deal[0], words), words, n):
            rows.append(_row("words", at, len(x[0]), *x))
        x = grams.heads[split], grams.tails[split], counts[split]
        for at, *x in _dealt(_of_word(deal[0], x[1]), *x):
            rows.append(_row("split", at, len(x[0]), *x))
        return pd.DataFrame(rows, columns=columns)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        at = int(group["at"].iloc[0])
        words, n = _all_unpacked(group[group["kind"] == "words"], "u8", "i8")
        heads, tails, counts = _all_unpacked(group[group["kind"] == "split"], "u8", "u8", "i8")
        _, first, of = np.unique(_joined(heads, tails), return_index=True, return_inverse=True)
        counts = np.bincount(of, counts, len(first)).astype(np.int64)
        heads, tails = heads[first], tails[first]
        words, of = np.unique(np.append(words, tails), return_inverse=True)
        n = np.bincount(of, np.append(n, np.ones(len(tails)))).astype(np.int64)
        rows = [_row("words", at, len(words), words, n), _row("total", 0, int(n.sum()))]
        rows += [_row("one", i, found) for i, found in _counts_of(n).items()]
        if len(heads):
            rows.append(_row("split", at, len(heads), heads, tails, counts))
            rows += [_row("two", i, found) for i, found in _counts_of(counts).items()]
        for word in np.unique(heads):
            own = counts[heads == word]
            for i, found in (*_counts_of(own).items(), (0, int(own.sum()))):
                rows.append(_row("context", i, found, key=int(word.view(np.int64))))
        return pd.DataFrame(rows, columns=columns)

    turns = []
    for turn in range(rounds):
        places_ = texts.select("text").mapInPandas(dealt(turn), "shard int, n long, body binary")
        counted = places_.groupBy("shard").applyInPandas(count, STATED)
        turns.append(scratch.store(counted, f"turn-{turn}"))
    counted = reduce(DataFrame.union, turns)
    merged = counted.filter("body is not null").groupBy("at").applyInPandas(merge, STATED)
    merged = scratch.store(merged, "merged")
    sums: dict[tuple[str, int], Counter] = {}
    stated = counted.union(merged).filter("body is null").groupBy("kind", "key", "at")
    for r in stated.agg(F.sum("n").alias("n")).collect():
        sums.setdefault((r["kind"], r["key"]), Counter())[r["at"]] += r["n"]
    scratch.drop(*(f"turn-{turn}" for turn in range(rounds)))

    def of(kind: str, word: int = 0) -> Counter:
        return sums.get((kind, word), Counter())

    cuts = tuple(_discounts(of(order)) for order in ("one", "two", "three"))

    def freed(counts: Counter, cut: tuple) -> float:
        return cut[0] * counts[1] + cut[1] * counts[2] + cut[2] * (counts[3] + counts[4] + counts[5])

    total, hot = of("total")[0], deal[1].view(np.int64).tolist()
    known = sum(of("one").values())
    # Starts are contexts, and so among the known words.
    floor = (freed(of("one"), cuts[0]) / total if total else 1.0) / (max(known + (known > 0), 1) + 1)
    return Model(
        merged.filter("body is not null").select("at", "kind", "n", "body"),
        cuts,
        total,
        floor,
        np.array([of("context", word)[0] for word in hot], np.float64),
        np.array([freed(of("context", word), cuts[1]) for word in hot], np.float64),
    )


NEEDED = "shard int, model int, n long, body binary"


def needed(texts: DataFrame, models: list[Model], layout: Layout) -> DataFrame:
    """(shard, model, n, body): the words' counts that shards need, in all models, and
    of each model the counts of bigrams that split words begin."""
    deal = layout.deal()
    many = len(models)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, least = [], 0, 0

        def asked() -> pd.DataFrame:
            words, to = (np.concatenate(x) for x in zip(*held, strict=True))
            rows = [
                (at, len(x[0]), packed(*x))
                for at, *x in _dealt(_of_word(deal[0], words), words, to)
            ]
            return pd.DataFrame(rows, columns=["at", "n", "body"])

        for frame in frames:
            w1, w2, words, _ = places(list(frame["text"]))
            held.append(_once(words, _shard(deal, w1, w2).astype(np.int32)))
            size += len(held[-1][0])
            if size > max(ASKED, 2 * least):
                held = [_once(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                size = least = len(held[0][0])
            if size > 2 * ASKED:
                yield asked()
                held, size, least = [], 0, 0
        if held:
            held = [_once(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            yield asked()

    def answer(group: pd.DataFrame, models_: pd.DataFrame) -> pd.DataFrame:
        words, to = _once(*_all_unpacked(group, "u8", "i4"))
        counts = []
        for i in range(many):
            own = models_[(models_["model"] == i) & (models_["kind"] == "words")]
            counts.append(_found(words, *_all_unpacked(own, "u8", "i8")).astype(np.int32))
        known = np.any(counts, axis=0)
        rows = [
            (shard, -1, len(x[0]), packed(*x))
            for shard, *x in _dealt(to[known], words[known], *(c[known] for c in counts))
        ]
        return pd.DataFrame(rows, columns=["shard", "model", "n", "body"])

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Bigrams of split words go to all shards of their first word."""
        for frame in frames:
            rows = []
            for model, n, body in zip(frame["model"], frame["n"], frame["body"], strict=True):
                heads, tails, counts = unpacked(n, body, "u8", "u8", "i8")
                for head in np.unique(heads):
                    own = heads == head
                    parts = np.arange(int(deal[2][np.searchsorted(deal[1], head)]))
                    keys = _part(np.full(len(parts), head), parts)
                    for shard in np.unique(_of_word(deal[0], keys)).tolist():
                        x = _joined(heads[own], tails[own]), counts[own]
                        rows.append((shard, model, len(x[0]), packed(*x)))
            yield pd.DataFrame(rows, columns=["shard", "model", "n", "body"])

    asked = texts.select("text").mapInPandas(ask, "at int, n long, body binary")
    words = reduce(
        DataFrame.union, [m.words.withColumn("model", F.lit(i)) for i, m in enumerate(models)]
    )
    answers = (
        asked.groupBy("at")
        .cogroup(words.filter("kind = 'words'").groupBy("at"))
        .applyInPandas(answer, NEEDED)
    )
    split = words.filter("kind = 'split'").select("model", "n", "body")
    answers = layout.scratch.store(answers, "answers")
    return answers.union(layout.scratch.store(split.mapInPandas(spread, NEEDED), "split"))


def _once(words: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word once for each shard."""
    first = np.unique(_joined(words, to.astype(np.uint64)), return_index=True)[1]
    return words[first], to[first]


def _found(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The counts of wanted keys, zero where there is none; keys may be in any order."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[order[at]], 0)


def _parted(part: np.ndarray, whole: np.ndarray, none: float) -> np.ndarray:
    """Quotients as the model holds them, ``none`` where the whole is zero."""
    return np.where(whole > 0, part / np.maximum(whole, 1e-300), none).astype(np.float32).astype(float)


def _logs(
    grams: Grams,
    counts: np.ndarray,
    word_counts: np.ndarray,
    split: tuple[np.ndarray, np.ndarray],
    hot: np.ndarray,
    numbers: tuple,
) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct trigrams, the log probability and the last word's own share, from
    how often each occurs in what the model is fitted on."""
    cuts, total, floor, totals, freed = numbers
    own = floor + _parted(word_counts - _cut(word_counts, cuts[0]), np.float64(total), 0.0)
    twos = grams.bigram_counts(counts)
    middles, middle = np.unique(grams.heads, return_inverse=True)
    at = np.minimum(np.searchsorted(hot, middles), max(len(hot) - 1, 0))
    is_hot = hot[at] == middles if len(hot) else np.zeros(len(middles), bool)
    twos = np.where(is_hot[middle], _found(grams.bigrams, *split), twos)
    cut = _cut(twos, cuts[1])
    whole, loose = np.bincount(middle, twos), np.bincount(middle, cut)
    whole[is_hot], loose[is_hot] = totals[at[is_hot]], freed[at[is_hot]]
    share, weight = _parted(twos - cut, whole[middle], 0.0), _parted(loose, whole, 1.0)[middle]
    p = own * weight[grams.bigram] + share[grams.bigram]
    cut = _cut(counts, cuts[2])
    whole, loose = np.bincount(grams.context, counts), np.bincount(grams.context, cut)
    weight = _parted(loose, whole, 1.0)[grams.context]
    return np.log(p * weight + _parted(counts - cut, whole[grams.context], 0.0)), own


def scores(texts: DataFrame, models: list[Model], layout: Layout) -> DataFrame:
    """(a, b, good, good_rest, bad, bad_rest, word) of distinct texts (a, b, text, fits):
    whole and rest of the sums of the logarithms in the first and the last model, over
    all copies.  Bit i of ``fits`` says that model i is fitted on the text."""
    scratch, deal, rounds = layout.scratch, layout.deal(), layout.rounds
    numbers = [m.numbers() for m in models]
    known = needed(texts, models, layout)

    def dealt(turn: int):
        def deal_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for i in range(0, len(frame), BLOCK):
                    yield deal_block(frame.iloc[i : i + BLOCK])

        def deal_block(block: pd.DataFrame) -> pd.DataFrame:
            w1, w2, w3, doc = places(list(block["text"]))
            ids = [block[c].to_numpy(t) for c, t in (("a", "i8"), ("b", "i8"), ("fits", "u1"))]
            to = _shard(deal, w1, w2)
            mine = to % rounds == turn
            rows = []
            for shard, *x, doc in _dealt(to[mine], w1[mine], w2[mine], w3[mine], doc[mine]):
                new = np.diff(doc, prepend=-1) > 0  # in the texts' order
                own = packed(*(column[doc[new]] for column in ids))
                of = (np.cumsum(new) - 1).astype("i4")
                rows.append((shard, len(doc), packed(*x, of), int(new.sum()), own))
            return pd.DataFrame(rows, columns=["shard", "n", "body", "docs", "ids"])

        return deal_out

    def score(group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = ["a", "b", "good", "bad", "word"]
        if not len(group):
            return pd.DataFrame([], columns=columns)
        w1, w2, w3, doc = _all_unpacked(group, "u8", "u8", "u8", "i4")
        docs = group[["docs", "ids"]].set_axis(["n", "body"], axis=1)
        a, b, fits = _all_unpacked(docs, "i8", "i8", "u1")
        doc = doc + np.repeat(np.cumsum(group["docs"]) - group["docs"], group["n"]).to_numpy()
        grams = Grams(w1, w2, w3)
        del w1, w2, w3
        words, *word_counts = _all_unpacked(
            known[known["model"] == -1], "u8", *["i4"] * len(numbers)
        )
        lasts, last = np.unique(grams.last, return_inverse=True)
        found = []
        for i, own in enumerate(numbers):
            counts = np.bincount(grams.of, (fits[doc] >> i) & 1).astype(np.int64)
            split = _all_unpacked(known[known["model"] == i], "u8", "i8")
            seen = _found(lasts, words, word_counts[i])[last]
            found.append(_logs(grams, counts, seen, split, deal[1], own))
        starts = np.flatnonzero(np.diff(doc, prepend=-1))  # places are in the texts' order
        (good, share), (bad, bad_share) = found[0], found[-1]
        logs = [np.rint(x * 2.0**FIXED).astype(np.int64)[grams.of] for x in (good, bad)]
        word = (bad_share / share)[grams.of]
        sums = [np.add.reduceat(x, starts) for x in logs]
        return pd.DataFrame(
            dict(zip(columns, (a, b, *sums, np.maximum.reduceat(word, starts)), strict=True))
        )

    dealt_as = "shard int, n long, body binary, docs long, ids binary"
    turns = []
    for turn in range(rounds):
        out = texts.select("a", "b", "fits", "text").mapInPandas(dealt(turn), dealt_as)
        own = known.filter(F.col("shard") % rounds == turn)
        partly = (
            out.groupBy("shard")
            .cogroup(own.groupBy("shard"))
            .applyInPandas(score, "a long, b long, good long, bad long, word double")
        )
        # Sums of many copies could pass 64 bits: whole and rest are added apart.
        turns.append(scratch.store(_added(_whole_and_rest(partly)), f"turn-{turn}"))
    return _added(reduce(DataFrame.union, turns))


def _whole_and_rest(partly: DataFrame) -> DataFrame:
    split = [
        x
        for c in ("good", "bad")
        for x in (
            F.shiftright(c, FIXED).alias(c),
            F.col(c).bitwiseAND((1 << FIXED) - 1).alias(f"{c}_rest"),
        )
    ]
    return partly.select("a", "b", *split, "word")


def _added(partly: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("good", "good_rest", "bad", "bad_rest")]
    return partly.groupBy("a", "b").agg(*sums, F.max("word").alias("word"))


def thresholds(
    trusted: DataFrame, quantile: float, score: str = "perplexity"
) -> DataFrame:
    """(lang, pooled, threshold): a score's quantile of each language and of all."""
    pooled = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("pooled"))
    own = F.struct("lang", F.lit(False).alias("pooled"))
    binned = trusted.select(
        F.explode(F.array(own, pooled)).alias("of"),
        F.floor(F.log(score) * BIN).alias("bin"),
    )
    counts = binned.groupBy("of", "bin").count()
    of = W.partitionBy("of")
    counts = counts.withColumn("seen", F.sum("count").over(of.orderBy("bin")))
    counts = counts.withColumn("all", F.sum("count").over(of))
    reached = counts.filter(F.col("seen") >= quantile * F.col("all"))
    limit = F.exp((F.min("bin") + 1) / F.lit(float(BIN)))
    limits = reached.groupBy("of").agg(limit.alias("threshold"))
    return limits.select("of.lang", "of.pooled", "threshold")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, lang, n_tokens, perplexity, threshold, accepted, *carry), a row per input row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        text.alias("text"),
        F.col("lang").cast("string").alias("lang"),
        # Equal texts score alike, so texts are told apart by 128 bits of hashes.
        F.xxhash64(F.lit(1), text).alias("a"),
        F.xxhash64(F.lit(2), text).alias("b"),
        *carry,
    )
    labelled = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.every(F.col("quality").eqNullSafe(1)).alias("good"),
        F.every(F.col("toxic").eqNullSafe(0)).alias("mild"),
        F.some(F.col("quality").eqNullSafe(0) | F.col("toxic").eqNullSafe(1)).alias("bad"),
    )
    labelled = scratch.store(labelled.filter("label_id is not null"), "labelled")
    trusted, bad = labelled.filter("good and mild"), labelled.filter("bad")
    kept = F.xxhash64("label_id", F.lit(9)) / F.lit(2.0**64) + 0.5 >= 1.0 - HELD_OUT

    def labelled_so(of: DataFrame, ids: DataFrame) -> DataFrame:
        return of.join(ids.select(F.col("label_id").alias("id")), "id", "left_semi")

    with passing(spark):  # all that is stored or shuffled for the scores goes with them
        own = Scratch(spark, "quality-model")
        fits = F.when(F.col("good") & F.col("mild") & ~kept, 1).otherwise(0)
        fits = fits + F.when(F.col("bad"), 2).otherwise(0)
        texts = marked(rows, labelled.select(F.col("label_id").alias("id"), fits.alias("fits")), own)
        layout, sizes = laid_out(texts, own)
        fitted_on = [texts.filter(F.col("fits").bitwiseAND(1 << i) > 0) for i in (0, 1)]
        models = [train(fitted_on[0].select("text"), layout)]
        if not fitted_on[1].isEmpty():
            models.append(train(fitted_on[1].select("text"), layout))
        summed = scores(texts, models, layout).join(sizes, ["a", "b"])
        mean = {
            c: (F.col(c) + F.col(f"{c}_rest") / 2.0**FIXED) / (F.col("copies") * F.col("n_tokens"))
            for c in ("good", "bad")
        }
        scored = summed.select(
            "a",
            "b",
            "n_tokens",
            F.exp(-mean["good"]).alias("perplexity"),
            # How much better the rejected texts' model foretells it; 1 without one.
            (F.exp(-mean["good"]) / F.exp(-mean["bad"])).alias("likeness"),
            "word",
        )
        scored = rows.select("a", "b", "id", "lang", *carry).join(scored, ["a", "b"])
        scored = scratch.store(scored.drop("a", "b"), "scored")
    held_out = labelled_so(scored, trusted.filter(kept))
    judged = scored
    limited = {"perplexity": "threshold", "likeness": "most", "word": "most_word"}
    for value, name in limited.items():
        limits = scratch.store(thresholds(held_out, quantile, value), f"{name}-limits")
        own = limits.filter("not pooled").select(
            F.col("lang").alias("of"), F.col("threshold").alias("own")
        )
        pooled = limits.filter("pooled").agg(F.max("threshold").alias("pooled"))
        judged = (
            judged.join(own, judged["lang"].eqNullSafe(own["of"]), "left")
            .join(pooled)
            .withColumn(name, F.coalesce("own", "pooled"))
            .drop("of", "own", "pooled")
        )
    fits = F.expr(" and ".join(f"{value} <= {name}" for value, name in limited.items()))
    return judged.withColumn("accepted", F.coalesce(fits, F.lit(True))).select(
        "id", "lang", "n_tokens", "perplexity", "threshold", "accepted", *carry
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    spark = docs.sparkSession
    kept = Scratch(spark, "quality-rejected")
    keyed = with_row_key(docs)
    with passing(spark):
        judged = classify(fields(keyed, "doc_id", "text", "lang"), labels, carry=("row",))
        gone = kept.store(judged.filter("not accepted").select("row").distinct(), "rejected")
    return keyed.join(gone, "row", "left_anti").select("doc.*")
