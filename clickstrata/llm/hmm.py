"""Hidden Markov language model with exact likelihoods.

Words become symbols: the ``HEAD`` most frequent training words and the end of a
text have one each, all others share ``CLASSES`` classes by their last letters.
A state emits a symbol, and a symbol a word by its smoothed share of the class:

    P(word | state) = P(symbol | state) * (c(word) + 0.1) / Z(symbol)

so the model's size is bounded while every word of the corpus keeps its own
count.  The likelihood of a text under this model is exact: the scaled forward
recursion over its symbols, plus the words' shares.

* Words are counted per task and summed by a shuffle.
* ``encode`` turns each text into symbols.  Counts of rarer words can't be
  broadcast; they are joined by word, after adding up repeats in a document.
* Baum-Welch starts from a fit on ``INIT_DOCS`` training documents (a documented
  bound), then makes ``ROUNDS`` passes over all training documents: each task
  adds up expected counts, a shuffle sums them by symbol, and the driver gets one
  row per symbol and state.

Defined results: a null text is empty and consists of the end alone; a null id
counts as the text '' in the hash; rows with equal ids are scored one by one; an
empty table gives no rows, and without training documents every count is zero
and the model is uniform.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.common import Scratch, text_id, words

ADD = 0.1  # added to every count
STATES = 8
HEAD = 40_000
CLASSES = 4_096
INIT_DOCS = 400
INIT_ROUNDS = 15
ROUNDS = 3
PRIOR = 200.0  # weight of the corpus-wide symbol shares in each state
DISTINCT = 200_000  # words a task counts before it passes them on
TOKENS = 300_000  # tokens that one recursion runs over
LENGTHS = (128, 512, 2048, 8192)  # texts of similar length run together


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@F.pandas_udf(T.IntegerType())
def _class_of(found: pd.Series) -> pd.Series:
    return found.map(lambda word: word_class(word.encode()))


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()

    def passed_on() -> pd.DataFrame:
        found = [word.decode() for word in counts]
        return pd.DataFrame({"word": found, "c": list(counts.values())})

    for frame in frames:
        for text in frame["text"]:
            counts.update(words(text))
            if len(counts) > DISTINCT:
                yield passed_on()
                counts.clear()
    if counts:
        yield passed_on()


def _encoder(shared):
    """Rows of symbols, with what the counts of head words already give."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, counts = shared.value
        symbol = {word: i + 1 for i, word in enumerate(head)}
        logs = np.log10(counts + ADD)
        first_class = len(counts)
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                rows = []
                for id_, held_out, text in zip(
                    part["id"], part["held_out"], part["text"], strict=True
                ):
                    found = words(text)
                    codes = [symbol.get(word, -1) for word in found]
                    tail: Counter[bytes] = Counter()
                    for i, code in enumerate(codes):
                        if code < 0:
                            tail[found[i]] += 1
                            codes[i] = first_class + word_class(found[i])
                    codes.append(0)
                    codes = np.array(codes, dtype=np.uint16)
                    own = codes[codes < first_class]
                    rows.append(
                        (
                            id_,
                            held_out,
                            len(codes),
                            codes.tobytes(),
                            float(logs[own].sum()),
                            int((counts[own] > 0).sum()),
                            [word.decode() for word in tail],
                            list(tail.values()),
                        )
                    )
                yield pd.DataFrame(rows, columns=ENCODED)

    return encode


ENCODED = ["id", "held_out", "n_tokens", "codes", "head_sum", "head_known", "tail", "tf"]
ENCODED_SCHEMA = (
    "id string, held_out boolean, n_tokens long, codes binary, head_sum double, "
    "head_known long, tail array<string>, tf array<int>"
)

# --- the recursions -----------------------------------------------------------


class Packed:
    """Symbol sequences laid out by time step, the longest first."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        flat = np.concatenate([sequences[i] for i in self.order])
        self.first = np.concatenate([[0], np.cumsum(lengths[:-1])])
        # How many sequences are longer than t, for each step t.
        ended = np.cumsum(np.bincount(lengths))[:-1]
        self.active = len(lengths) - ended
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        step = np.arange(len(flat)) - np.repeat(self.first, lengths)
        # Sequences are sorted by length, so each step holds a prefix of them.
        self.place = self.start[step] + np.repeat(np.arange(len(lengths)), lengths)
        self.symbols = np.empty(len(flat), dtype=np.int64)
        self.symbols[self.place] = flat

    def forward(self, pi, move, emit) -> tuple[np.ndarray, np.ndarray]:
        """Scaled state probabilities and scales, by position."""
        return self._forward(pi, move, emit.take(self.symbols, axis=0))

    def _forward(self, pi, move, alpha) -> tuple[np.ndarray, np.ndarray]:
        """The recursion, in place over the emission probabilities ``alpha``."""
        scale = np.empty(len(alpha), dtype=alpha.dtype)
        ones = np.ones(alpha.shape[1], dtype=alpha.dtype)
        before = None
        starts = self.start.tolist()
        for begin, end in zip(starts, starts[1:], strict=False):
            now = alpha[begin:end]
            now *= pi if before is None else before[: end - begin] @ move
            total = now @ ones
            now /= total[:, None]
            scale[begin:end] = total
            before = now
        return alpha, scale

    def log10(self, scale: np.ndarray) -> np.ndarray:
        """Log likelihoods in the order in which the sequences were given."""
        result = np.empty(len(self.first))
        result[self.order] = np.add.reduceat(np.log10(scale)[self.place], self.first)
        return result

    def expected(self, pi, move, emit, n_symbols: int):
        """Expected first states, moves, and emissions (states x symbols).

        In the precision of ``emit``; sums over symbols are in doubles.
        """
        ahead = emit.take(self.symbols, axis=0)
        alpha, scale = self._forward(pi, move, ahead.copy())
        ahead /= scale[:, None]  # becomes emission * beta / scale
        beta = np.ones_like(alpha)
        back = np.ascontiguousarray(move.T)
        starts = self.start.tolist()
        for t in range(len(starts) - 3, -1, -1):
            begin, end, last = starts[t : t + 3]
            after = ahead[end:last]
            after *= beta[end:last]
            np.matmul(after, back, out=beta[begin : begin + last - end])
        first = int(self.active[0])
        width = np.repeat(self.active[:-1], self.active[1:])
        previous = alpha.take(np.arange(first, len(alpha)) - width, axis=0)
        moves = move * (previous.T @ ahead[first:])
        beta *= alpha
        emissions = np.stack(
            [
                np.bincount(self.symbols, weights=g, minlength=n_symbols)
                for g in np.ascontiguousarray(beta.T)
            ]
        )
        return beta[:first].sum(axis=0), moves, emissions


def by_length(rows: Iterator[tuple], codes_at: int) -> Iterator[list[tuple]]:
    """Rows in lists of similar length and at most about TOKENS symbols."""
    held: dict[int, list[tuple]] = {}
    sizes: Counter[int] = Counter()
    for row in rows:
        n = len(row[codes_at]) // 2
        kind = sum(n > limit for limit in LENGTHS)
        if held.get(kind) and sizes[kind] + n > TOKENS:
            yield held.pop(kind)
            sizes[kind] = 0
        held.setdefault(kind, []).append(row)
        sizes[kind] += n
    yield from held.values()


def _sequences(rows: list[tuple], codes_at: int) -> list[np.ndarray]:
    return [np.frombuffer(row[codes_at], dtype=np.uint16) for row in rows]


def start_model(shares: np.ndarray, seed: int = 0):
    """First guess: the corpus-wide shares, disturbed differently in each state."""
    random = np.random.default_rng(seed)
    emit = shares * np.exp(random.normal(0.0, 0.5, (STATES, len(shares))))
    move = np.full((STATES, STATES), 0.2 / (STATES - 1))
    np.fill_diagonal(move, 0.8)
    return (
        np.full(STATES, 1.0 / STATES),
        move,
        np.ascontiguousarray((emit / emit.sum(axis=1, keepdims=True)).T),
    )


def reestimated(first, moves, emissions, shares):
    """New parameters from expected counts."""
    pi = first + 1.0
    moves = moves + 1.0
    emit = emissions + PRIOR * shares
    return (
        pi / pi.sum(),
        moves / moves.sum(axis=1, keepdims=True),
        np.ascontiguousarray((emit / emit.sum(axis=1, keepdims=True)).T),
    )


def _expectation(shared, n_symbols: int):
    """Expected counts of a task: a row per symbol, then moves and first states."""

    def expect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        first, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        emissions = np.zeros((STATES, n_symbols))
        rows = ((codes,) for frame in frames for codes in frame["codes"])
        for part in by_length(rows, 0):
            f, m, e = Packed(_sequences(part, 0)).expected(*model, n_symbols)
            first += f
            moves += m
            emissions += e
        seen = np.flatnonzero(emissions.sum(axis=0))
        table = np.concatenate([emissions[:, seen].T, moves, first[None]])
        index = [*seen, *range(-STATES, 0), -STATES - 1]
        frame = pd.DataFrame(table, columns=[f"s{k}" for k in range(STATES)])
        frame.insert(0, "symbol", np.array(index, dtype=np.int32))
        yield frame

    return expect


def baum_welch(encoded: DataFrame, shares: np.ndarray):
    """Parameters fitted on the training rows of ``encoded``."""
    spark = encoded.sparkSession
    training = encoded.filter("not held_out").select("id", "codes")
    drawn = training.orderBy(F.xxhash64("id", F.lit(1)), "codes").limit(INIT_DOCS)
    model = start_model(shares)
    sample = [np.frombuffer(row.codes, np.uint16) for row in drawn.collect()]
    n = len(shares)
    if not sample:
        return model
    for _ in range(INIT_ROUNDS):
        counts = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, n))]
        for part in by_length(((s.tobytes(),) for s in sample), 0):
            for total, own in zip(
                counts, Packed(_sequences(part, 0)).expected(*model, n), strict=True
            ):
                total += own
        model = reestimated(*counts, shares)
    columns = [f"s{k}" for k in range(STATES)]
    schema = "symbol int, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        parts = training.select("codes").mapInPandas(_expectation(shared, n), schema)
        summed = parts.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns])
        found = summed.toPandas().set_index("symbol")
        table = found[columns]
        emissions = np.zeros((STATES, n))
        symbols = table[table.index >= 0]
        emissions[:, symbols.index] = symbols.to_numpy().T
        moves = table.loc[list(range(-STATES, 0))].to_numpy()
        model = reestimated(
            table.loc[-STATES - 1].to_numpy(), moves, emissions, shares
        )
        shared.unpersist()
    return model


def _scorer(shared):
    keys = ["rid", "id", "held_out", "n_tokens", "head_sum", "head_known"]

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, log_z = shared.value
        columns = [*keys, "codes"]
        rows = (
            row
            for frame in frames
            for row in frame[columns].itertuples(index=False, name=None)
        )
        for part in by_length(rows, len(keys)):
            sequences = _sequences(part, len(keys))
            packed = Packed(sequences)
            _, scale = packed.forward(*model)
            logs = packed.log10(scale)
            logs -= [log_z[sequence].sum() for sequence in sequences]
            frame = pd.DataFrame([row[:-1] for row in part], columns=keys)
            frame["symbols"] = logs
            yield frame

    return score


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        text_id(id_col),
        (F.crc32(key) % 10 == 0).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    training = rows.filter("not held_out")
    counted = training.select("text").mapInPandas(_count_words, "word string, c long")
    counts = scratch.store(
        counted.groupBy("word").agg(F.sum("c").alias("c")), "counts"
    )
    size = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    texts = training.count()
    total, distinct = (size.n or 0) + texts, size.v + (texts > 0)

    head = counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()
    head_counts = np.array([texts, *(row.c for row in head)], dtype=np.float64)
    edge = (head[-1].c, head[-1].word) if head else (0, "")
    rare = counts.filter(
        (F.col("c") < edge[0]) | ((F.col("c") == edge[0]) & (F.col("word") > edge[1]))
    )
    classes = rare.groupBy(_class_of("word").alias("class")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    )
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in classes.collect():
        mass[row["class"]], kinds[row["class"]] = row.c, row.v
    # A class also keeps the mass of one word that it has never seen.
    z = mass + ADD * (kinds + 1)
    shares = np.concatenate([head_counts + ADD, z])
    shares /= shares.sum()
    log_z = np.concatenate([np.zeros(len(head_counts)), np.log10(z)])

    shared = spark.sparkContext.broadcast(
        ([row.word.encode() for row in head], head_counts)
    )
    encoded = rows.mapInPandas(_encoder(shared), ENCODED_SCHEMA)
    encoded = scratch.store(
        encoded.withColumn("rid", F.monotonically_increasing_id()), "encoded"
    )
    model = baum_welch(encoded, shares)

    tail = encoded.select(
        "rid", F.explode(F.arrays_zip("tail", "tf")).alias("t")
    ).select("rid", F.col("t.tail").alias("word"), F.col("t.tf").alias("tf"))
    c = F.coalesce("c", F.lit(0))
    tails = (
        tail.join(rare, "word", "left")
        .groupBy("rid")
        .agg(
            F.sum(F.col("tf") * F.log10(c + ADD)).alias("tail_sum"),
            F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("tail_known"),
        )
    )
    schema = (
        "rid long, id string, held_out boolean, n_tokens long, head_sum double, "
        "head_known long, symbols double"
    )
    scored = encoded.drop("tail", "tf").mapInPandas(
        _scorer(spark.sparkContext.broadcast((model, log_z))), schema
    )
    tail_sum = F.coalesce("tail_sum", F.lit(0.0))
    known = F.col("head_known") + F.coalesce("tail_known", F.lit(0))
    per_token = float(np.log10(total + ADD * (distinct + 1)))
    return scored.join(tails, "rid", "left").select(
        F.col("id").cast("long").alias("id"),
        "held_out",
        "n_tokens",
        known.cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("head_sum") + tail_sum - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("symbols") + tail_sum).alias("score"),
    )
