"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton reports all pieces that end at each character of a
word.  The dynamic programme carries the best score and its number of pieces per
position, and no back pointers.  It follows the tokenizer's rules exactly: words
are parted at white space and begin with the word mark; of equal scores the path
whose last piece begins first wins, since later ones replace it only if they are
better; a character that no piece of its own covers costs the lowest score less
ten, and becomes one piece per byte.  Equal words have equal counts, so a task
keeps those it has seen in a bounded table.

Defined results: a null or empty text has no pieces and score zero; rows with
equal or null ids are counted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import small_batches, text_id, worker_store

# The word mark, the penalty of unknown characters, the white space.
MARK = "▁"
UNKNOWN = 10.0
SPACE = re.compile(r"[\x20\x09-\x0D]+")
KEPT = 300_000


class Counter:
    """Piece counts for a vocabulary of (piece, score)."""

    def __init__(self, vocabulary: list[tuple[str, float]], lowest: float):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.unknown = lowest - UNKNOWN
        self.seen: dict[str, tuple[int, float]] = {}

    @classmethod
    def from_model(cls, path: str) -> Counter:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [
            (model.id_to_piece(i), model.get_score(i))
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        return cls(plain, min(model.get_score(i) for i in ids))

    def word(self, word: str) -> tuple[int, float]:
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, piece in self.pieces.iter(word):
            ending[last + 1].append(piece)
        for end in range(1, n + 1):
            best, pieces, alone = float("-inf"), 0, False
            # From the earliest beginning to the latest: the longest piece first.
            for length, value in sorted(ending[end], reverse=True):
                alone |= length == 1
                if score[end - length] + value > best:
                    best = score[end - length] + value
                    pieces = count[end - length] + 1
            if not alone and score[end - 1] + self.unknown > best:
                best = score[end - 1] + self.unknown
                pieces = count[end - 1] + len(word[end - 1].encode())
            score[end], count[end] = best, pieces
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float]:
        pieces, total = 0, 0.0
        for word in SPACE.split(text or ""):
            if word:
                found = self.seen.get(word)
                if found is None:
                    if len(self.seen) >= KEPT:
                        self.seen.clear()
                    found = self.seen[word] = self.word(MARK + word)
                pieces += found[0]
                total += found[1]
        return pieces, total


def count_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_pieces, best_score) under the vocabulary in the file ``model``."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = worker_store()
        counter = store.get(f"unigram {model}")
        if counter is None:
            counter = store[f"unigram {model}"] = Counter.from_model(model)
        for frame in frames:
            rows = [counter.text(text) for text in frame["text"]]
            found = pd.DataFrame(rows, columns=["n_pieces", "best_score"])
            found.insert(0, "id", frame["id"].to_numpy())
            yield found

    small_batches(docs.sparkSession)
    rows = docs.select(
        text_id(id_col),
        F.col(text_col).cast("string").alias("text"),
    )
    counted = rows.mapInPandas(count, "id string, n_pieces long, best_score double")
    return counted.withColumn("id", F.col("id").cast("long"))
