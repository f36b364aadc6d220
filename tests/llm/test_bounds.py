"""What operators hold or ship at once stays bounded, with the same results."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clickstrata.llm import collocations, quality, wavelet
from clickstrata.llm.common import Scratch, words


def test_a_shard_is_built_and_read_in_little_memory():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 49_000, 400_000).astype("<u4")
    ends = np.array([100_000, 100_001, 400_000])
    tracemalloc.start()
    data = wavelet.build(tokens, np.arange(3), np.zeros(3, bool), ends)
    building = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    read = wavelet.WaveletFile(data).tokens()
    reading = tracemalloc.get_traced_memory()[1] - len(data)
    tracemalloc.stop()
    assert np.array_equal(read, tokens) and read.dtype == np.uint32
    assert building < 13 * len(tokens)
    assert reading < 13 * len(tokens)
    wide = tokens + np.uint32(1 << 20)  # more than 16 levels
    data = wavelet.build(wide, np.arange(3), np.zeros(3, bool), ends)
    assert np.array_equal(wavelet.WaveletFile(data).tokens(), wide)


def test_encoder_parts_words_as_the_tokenizer_does(monkeypatch):
    texts = [
        *[None, "", " ", " lead and trail. ", "\n a.b, c.  d..", "x A.,;!? <|endoftext|> z"],
        *["<|", "É.é, ÀB ća. é", "a|b| *c* $5% foo#& a1. b!c", "\x1c a\x1fb\x85  c", "ﬁ. ß, İ"],
    ]
    texts += [" ".join(f"w{chr(97 + i % 26)}{j}x." for j in range(40)) for i in range(90)]
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(wavelet, "KEPT", 1000)
    encoder = wavelet.Encoder(path)
    for at in range(0, len(texts), 8):
        some = texts[at : at + 8]
        for text, ids in zip(some, encoder(some), strict=True):
            plain = tokenizer.encode(text or "", add_special_tokens=False)
            assert ids.tolist() == [*plain.ids, wavelet.END_ID]
    assert len(encoder.seen) < 2000


def test_pieces_are_parted_as_the_rule_says():
    rule = re.compile(rb"[ \t]*[.,;:!?\x0A-\x0D][ \t.,;:!?\x0A-\x0D]*")
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("aB .,;:!?\n\r\x0b\x0c\t\x1cé") for _ in range(rng.randrange(25)))
        folded = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())
        assert collocations.tokens(text) == rule.sub(b" . ", folded).split()


@pytest.mark.parametrize("n", [1, 2, 3])
def test_runs_are_counted_without_sorting(monkeypatch, n):
    rng = np.random.default_rng(4)
    langs = [f"l{x}" for x in rng.integers(0, 5, 300)]
    rows = [[b"." if x == 9 else b"w%d" % x for x in rng.integers(0, 12, 20)] for _ in langs]
    weights = rng.integers(1, 9, 300)
    table = pa.table(
        {
            "lang": langs,
            "chunk": [b" ".join(row).decode() for row in rows],
            "n": pa.array(weights, pa.int64()),
        }
    )
    plain = Counter()
    for lang, row, weight in zip(langs, rows, weights.tolist(), strict=True):
        for i in range(len(row) - 2):
            run = row[i : i + n]
            if b"." not in run:
                plain[lang, b" ".join(run).decode()] += weight
    monkeypatch.setattr(np, "unique", None)
    full = np.full(collocations.BITS // 8, 255, np.uint8)
    found = collocations.runs(table, n, 2, [full] * (n - 1))
    assert len(found) == len(plain)
    assert {(r["lang"], r["phrase"]): r["n"] for r in found.to_pylist()} == plain


def test_only_words_are_repeated_for_the_lookups(spark):
    counts = spark.createDataFrame(
        [("en", "a", 40, 1), ("en", "b", 30, 1), ("en", "c", 20, 1)]
        + [("en", "a b", 20, 2), ("en", "b c", 15, 2), ("en", "a b c", 12, 3)],
        "lang string, phrase string, f long, words int",
    )
    scored = collocations._scored(counts.filter("words > 1"), counts, None)
    found = {r.phrase: (r.a, r.l, r.r, r.score) for r in scored.collect()}
    assert found == {
        "a b": (20, 40, 30, 10**6 * 400 // 1200),
        "b c": (15, 30, 20, 10**6 * 225 // 600),
        "a b c": (12, 40, 15, 10**6 * 144 // 600),
    }
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (words" in plan  # how many salts a row gets


def test_classifier_leaves_no_model_or_count_behind(spark, monkeypatch):
    stored, dropped = set(), set()
    store, drop = Scratch.store, Scratch.drop

    def storing(self, df, name):
        stored.add(self.path(name))
        return store(self, df, name)

    def dropping(self, *names):
        drop(self, *names)
        gone = [self.path(name).rstrip("/") for name in names]
        dropped.update(x for x in stored if any(f"{x}/".startswith(f"{g}/") for g in gone))

    monkeypatch.setattr(Scratch, "store", storing)
    monkeypatch.setattr(Scratch, "drop", dropping)
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 30)), "en") for i in range(80)],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame(
        [(i, int(i < 50), 0) for i in range(70)], "doc_id long, quality int, toxic int"
    )
    judged = quality.classify(docs, labels)
    assert judged.count() == 80
    left = {x.rpartition("/")[2] for x in stored - dropped}
    assert left == {"labelled", "scored", *(f"{x}-limits" for x in ("threshold", "most", "most_word"))}


def test_places_are_words_after_the_two_before():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aBÉ x\0\t\n\x0b\x1c\x85 ") for _ in range(60)) for _ in range(99)]
    texts += [None, "", " ", "x" * 63, "x" * 64, "x" * 65, "x" * 9, "x" * 8, "X" * 200, "y" * 200]
    w1, w2, w3, doc = quality.places(texts)
    keys, at = {}, 0
    for i, text in enumerate(texts):
        before = [int(quality.START)] * 2
        for word in [*words(text), b" end"]:
            assert [int(w1[at]), int(w2[at]), int(doc[at])] == [*before, i]
            assert keys.setdefault(word, int(w3[at])) == int(w3[at])
            before, at = [before[1], int(w3[at])], at + 1
    assert at == len(w3) and len(set(keys.values())) == len(keys)
    assert len(quality.places([])[2]) == 0


def test_classifier_stores_no_row_for_an_ngram(spark, monkeypatch):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 300) % 999) for _ in range(120)]
    docs = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate([*texts, texts[0], None])],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame(
        [(i, int(i < 80), 0) for i in range(100)], "doc_id long, quality int, toxic int"
    )
    stored = []
    store = Scratch.store

    def storing(self, df, name):
        kept = store(self, df, name)
        stored.append(kept.count())
        return kept

    whole = sorted(quality.classify(docs, labels).collect())
    monkeypatch.setattr(Scratch, "store", storing)
    assert sorted(quality.classify(docs, labels).collect()) == whole
    assert max(stored) < 10 * len(texts)  # the texts have some 30,000 trigrams
    # The same from many shards, with frequent words split over several.
    monkeypatch.setattr(quality, "SHARD", 2000)
    monkeypatch.setattr(quality, "ASKED", 300)
    monkeypatch.setattr(quality, "TEXT_BYTES", 500)
    split, shard = [], quality.laid_out

    def laid_out(*args):
        layout, sizes = shard(*args)
        split.extend(layout.parts.tolist())
        assert layout.shards > layout.rounds == quality.ROUNDS
        return layout, sizes

    monkeypatch.setattr(quality, "laid_out", laid_out)
    found = sorted(quality.classify(docs, labels).collect())
    assert max(split) > 2
    for x, y in zip(found, whole, strict=True):
        assert x == pytest.approx(y, rel=1e-9) if x.perplexity != y.perplexity else x == y
