"""Top-k search, resampling and collocations against plain versions of themselves."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import collocations, resample, topk

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BIG = 2**53 + 1

# --- top-k --------------------------------------------------------------------


def plain_top_k(rows, k, scale=64):
    usable = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = Counter()
    for n, (q, v) in enumerate(usable):
        if q is None or q % 20:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w, strict=True)), c is None, c or 0)
            for m, (c, w) in enumerate(usable)
            if m != n and len(w) == len(v)
        ]
        for rank, (score, no_id, c) in enumerate(sorted(scores)[:k], 1):
            found[q, rank, None if no_id else c, -score] += 1
    return found


def found_top_k(spark, rows, k=20, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("row", "asks", "d", "v", "block", "id")})
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k, **options).collect()
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_top_k_over_many_blocks_with_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 3).tolist()) for i in range(900)]
    # A third of all rows are one vector, so most k-th values are ties over blocks.
    rows = [(i, [1.0] * 6 if i % 3 == 0 else v) for i, v in rows]
    found = found_top_k(spark, rows, query_rows=16, candidate_rows=100)
    assert found == plain_top_k(rows, 20)


def test_top_k_on_awkward_vectors(spark):
    rows = [
        (0, [0.0, 0.0]),
        (0, [1.0, -1.0]),
        (20, [1.0, -1.0]),
        (BIG, [1.0, 2.0]),
        (BIG + 1, [1.0, 2.0]),
        (None, [1.0, 2.0]),
        (None, [1.0, 2.0]),
        (40, None),
        (60, [1.0, None]),
        (80, [math.inf, 1.0]),
        (100, [math.nan, 1.0]),
        (120, [1.0, 2.0, 3.0]),
        (140, []),
        (141, []),
        (160, [3e6, -3e6]),
        (161, [-3e6, 3e6]),
    ]
    for k in (1, 3, 20):
        assert found_top_k(spark, rows, k) == plain_top_k(rows, k)
    assert not found_top_k(spark, [])
    assert not found_top_k(spark, [(1, [1.0])])


def test_top_k_of_scores_beyond_a_double(spark):
    rows = [(i, [float(2**24 + i), float(i)]) for i in range(45)]
    assert found_top_k(spark, rows, 5) == plain_top_k(rows, 5)


def test_top_k_with_many_blocks_in_a_share(spark):
    rng = np.random.default_rng(6)
    widths = [0.5, 30.0, 5000.0, 1e7]  # kept in one, two, four and eight bytes
    rows = [(i, (rng.normal(size=4) * widths[i // 75]).tolist()) for i in range(300)]
    assert math.ceil(len(rows) / 2) > 2 * topk.SHARES
    assert found_top_k(spark, rows, 7, query_rows=4, candidate_rows=2) == plain_top_k(rows, 7)


def test_top_k_never_broadcasts_blocks(spark):
    """Repeated for the candidates, queries reach any size, whatever theirs was reckoned."""
    rows = spark.createDataFrame(
        [(i, [float(i), 1.0]) for i in range(200)], "vec_id long, embedding array<double>"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10g")
    try:
        found = topk.top_k(rows, F.col("vec_id") % 20 == 0, 3, candidate_rows=10)
        plan = found._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_integers_are_kept_in_as_few_bytes_as_hold_them():
    for values, width in (([-128, 127], 1), ([-129, 0], 2), ([0, 32768], 4), ([2**31], 8), ([], 8)):
        kept = topk._narrow(np.array(values, np.int64))
        assert kept.itemsize == width and kept.tolist() == values


# --- resampling ---------------------------------------------------------------

TEXTS = [
    (1, "The CAT, sat on the mat. " * 5),
    (2, "the dog " * 12 + "É漢 x9"),
    (2, "the dog " * 12 + "É漢 x9"),
    (3, None),
    (4, ""),
    (5, " .,- "),
    (None, "no id " * 11),
    (BIG, "cat " * 300_000),
    (7, "one two three"),
] + [(100 + i, f"word{i % 7} cat sat word{i % 5} on the dog " * 4) for i in range(40)]
AIM = [("the cat sat on the mat",), (None,), ("A dog.",)]


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    runs = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
    return len(w), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain_resample(texts, aims):
    docs = [(i, *plain_features(t)) for i, t in texts]
    s = Counter(b for _, _, f in docs for b in f)
    t = Counter(b for (text,) in aims for b in plain_features(text)[1])
    of, to = sum(s.values()) + 10_000, sum(t.values()) + 10_000

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * of / ((s[b] + 1) * to)))

    gains = {b: gain(b) for b in s}
    rows = []
    for i, words, f in docs:
        weight = sum(gains[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        luck = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((words, i, len(f), weight, weight + luck))
    able = sorted(
        (r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2])
    )
    ranks = {id(r): n for n, r in enumerate(able[: len(able) * 25 // 100], 1)}
    return Counter((*r[1:], ranks.get(id(r))) for r in rows)


def found_resample(docs, aims):
    rows = resample.resample(docs, aims).collect()
    return Counter((r.id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)


def test_resampling_equals_the_plain_version(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("id", "weight", "rank", "score", "_at")})
    aims = spark.createDataFrame(AIM, "text string")
    expected = plain_resample(TEXTS, AIM)
    assert found_resample(docs, aims) == expected
    assert found_resample(docs.coalesce(1), aims) == expected
    assert found_resample(docs, aims.limit(0)) == plain_resample(TEXTS, [])
    assert resample.resample(docs.limit(0), aims).isEmpty()


def test_a_hot_id_is_numbered_by_many_tasks(spark):
    same = [(8, "a b c d " * 8)] * 600
    docs = spark.createDataFrame(same, "doc_id long, text string").repartition(8)
    rows = resample.resample(docs, docs.limit(1)).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 151))


# --- collocations -------------------------------------------------------------


def plain_collocations(texts, longest=3, least=10, within=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in texts:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    rows = []
    for (lang, p), a in candidates.items():
        inside = any(
            lang == other and len(q) > len(p) and 100 * b >= within * a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if inside:
            continue
        score, _, l, r = min(
            (10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        )
        rows.append((lang, -score, -a, " ".join(p).encode(), l, r, n[lang]))
    result, rank = set(), Counter()
    for lang, score, a, p, l, r, all_ in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            result.add((lang, rank[lang], p.decode(), -a, l, r, all_, -score))
    return result


def prose(n, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "of", "New", "york", "É", "漢字", "a", "b"] + [f"w{i}" for i in range(30)]
    chance = np.arange(len(vocabulary), 0, -1) ** 2.0
    rows = []
    for i in range(n):
        w = rng.choice(vocabulary, rng.integers(1, 60), p=chance / chance.sum())
        gaps = rng.choice([" ", "\t", ", ", ". ", "\n", " ; "], len(w), p=[0.8, 0.05, 0.05, 0.05, 0.025, 0.025])
        rows.append(("".join(a + b for a, b in zip(w, gaps, strict=True)), ["en", "fr", None][i % 3]))
    return rows


AWKWARD = [
    (None, "en"),
    ("", None),
    (" .,;:!? \t\n\x0b\x0c\r", "en"),
    ("New York city. " * 40, "en"),
    ("la la " * 6000, "fr"),
    ("x" * 70_000 + " y" * 30, "en"),
    ("under\x1cscore a\x00b \xa0 c d " * 12, ""),
]


@pytest.mark.parametrize(("longest", "every"), [(2, 4), (3, 1), (3, 16), (4, 5), (3, 10**9)])
def test_collocations_equal_the_plain_version(spark, longest, every):
    texts = prose(150) + AWKWARD + prose(20, 2) * 6
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(5)
    docs = docs.withColumns({c: F.lit(3) for c in ("n", "f", "words", "chunk", "phrase")})
    rows = collocations.collocations(docs, longest=longest, every=every).collect()
    assert {tuple(r) for r in rows} == plain_collocations(texts, longest)
    assert len(rows) > 100


def test_collocations_keep_to_the_top_and_take_empty_tables(spark):
    texts = prose(100)
    docs = spark.createDataFrame(texts, "text string, lang string")
    rows = collocations.collocations(docs, top=7).collect()
    assert {tuple(r) for r in rows} == plain_collocations(texts, top=7)
    assert collocations.collocations(docs.limit(0)).isEmpty()


def test_chunks_overlap_by_the_window_and_hold_each_token_once():
    text = collocations.tokens(" ".join(t for t, _ in prose(300)))
    for row in (text, text + [b"q"] * 9000, text + [b"z"] * 9000):
        parts = [c.split(b" ") for c in collocations.chunks(row, 2, collocations._Hashes())]
        assert [t for p in parts for t in p[:-2]] == row
        assert all(a[-2:] == b[:2] for a, b in zip(parts, parts[1:]))
        assert max(map(len, parts)) <= collocations.CHUNK + 2
    parts = list(collocations.chunks(text, 2, collocations._Hashes()))
    assert 8 < len(text) / len(parts) < 32


def test_a_repeated_passage_is_one_entry_of_the_dictionary(spark):
    passage = " ".join(f"p{i}" for i in range(400))
    docs = spark.createDataFrame([(passage, "en")] * 500, "text string, lang string")
    entries = collocations.parse(docs.repartition(8)).collect()
    assert len(entries) < 60 and {r.n for r in entries} == {500}


def test_large_counts_give_exact_scores(spark):
    a, l, r = 10**13 + 7, 3 * 10**13 + 1, 10**13 + 9
    counts = spark.createDataFrame(
        [("en", "x", l, 1), ("en", "y", r, 1), ("en", "x y", a, 2)],
        "lang string, phrase string, f long, words int",
    )
    row = collocations._scored(counts.filter("words > 1"), counts, None).first()
    assert row.score == 10**6 * a * a // (l * r)


def test_the_bitmap_agrees_with_the_workers(spark):
    phrases = spark.createDataFrame([("the cat é",), ("the",)], "phrase string")
    hashed = [r.h for r in phrases.select(collocations._hash(F.col("phrase")).alias("h")).collect()]

    def plain(words):
        h = 0
        for w in words:
            h = (h * collocations.FACTOR + zlib.crc32(w.encode())) & collocations.MASK
        return h

    assert hashed == [plain(["the", "cat", "é"]), plain(["the"])]


def test_hashed_runs_stay_inside_their_text():
    texts = pa.array(["a b c", "", "d", "..", "e f"])
    levels = list(resample.hashed_runs(texts, 3, 10**9))
    spelled = [["a", "b", "c", "d", "e", "f"], ["a b", "b c", "e f"], ["a b c"]]
    owners = [[0, 0, 0, 2, 4, 4], [0, 0, 4], [0]]
    for (document, bucket), words, owner in zip(levels, spelled, owners, strict=True):
        assert document.tolist() == owner
        assert bucket.tolist() == [zlib.crc32(w.encode()) % 10**9 for w in words]
