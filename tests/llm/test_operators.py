"""The training-data operators against brute force, and on awkward tables."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickstrata.llm import (
    exact_dedup,
    hmm,
    knn,
    mixing,
    packing,
    quality,
    simhash,
    unigram,
    warc,
    wavelet,
)
from clickstrata.llm.common import words
from clickstrata.llm.components import connected_components

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, h string, size long, fp long, node string"
)
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(9000))
ROWS = [
    (1, "The cat sat. On the mat!", "en", "b"),
    (2, "the CAT sat. on the mat!", "en", "a"),
    (2, "the CAT sat. on the mat!", "en", "a"),
    (3, None, None, None),
    (4, "", "en", None),
    (None, "no id here", "en", "b"),
    (5, LONG, "en", "a"),
    (6, LONG + " end", "en", "c"),
    (7, "É 漢字  x <|endoftext|> don't.", "fr", "b"),
]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame([(*r, 0, 9, "h", 9, 9, "n") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(messy):
    return messy.limit(0)


def test_exact_dedup(messy, empty):
    rows = exact_dedup.exact_dedup(messy, keep="largest").collect()
    found = sorted((r.id or 0, r.keep_id or 0, r.group_size, r.kept) for r in rows)
    assert found == [
        (0, 0, 1, True),
        (1, 2, 3, False),
        (2, 2, 3, True),
        (2, 2, 3, True),
        (3, 4, 2, False),
        (4, 4, 2, True),
        (5, 5, 1, True),
        (6, 6, 1, True),
        (7, 7, 1, True),
    ]
    assert exact_dedup.exact_dedup(empty).isEmpty()
    assert exact_dedup.without_copies(messy).columns == messy.columns


def test_mixing_meets_its_targets(messy, empty):
    rows = mixing.mix(messy).collect()
    assert len(rows) == len(ROWS) and mixing.mix(empty).isEmpty()
    taken, target, sizes = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = mixing.targets([sizes[s] for s in order], [5, 2, 1, 5], 3.0)
    for source, value in zip(order, expected, strict=True):
        assert target[source] == value and abs(taken[source] - value) <= 1
    assert mixing.mixed(messy).columns == messy.columns


def test_pigeonring_loses_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, False).astype(np.uint64))
             for n in rng.integers(1, 9, 400)]
    values = np.concatenate([base, rng.choice(base, 400) ^ np.array(flips)])
    for tau, m in ((2, 4), (2, 5), (7, 9), (7, 10)):
        masks = simhash.segments(m)
        found = set()
        for pattern, starts in simhash.chain_patterns(tau, m).items():
            mask = np.uint64(sum(masks[s] for s in pattern))
            buckets = defaultdict(list)
            for i, v in enumerate(values):
                buckets[int(v & mask)].append(i)
            for members in buckets.values():
                left, right = map(np.array, zip(*[(a, b) for a in members for b in members if a < b], strict=True)) if len(members) > 1 else (np.zeros(0, int),) * 2
                keep = simhash.follow_chains(values, left, right, tau, m, starts)
                found |= set(zip(left[keep].tolist(), right[keep].tolist(), strict=True))
        near = np.bitwise_count(values[:, None] ^ values) <= tau
        assert found == {(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b}


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}


def test_simhash(messy, empty):
    found = {(r.id, r.component_id, r.fp == 0) for r in simhash.simhash_components(messy).collect()}
    assert {(1, 1, False), (2, 1, False), (3, 3, True), (4, 3, True)} <= found
    assert simhash.simhash_components(empty).isEmpty()
    near = {r.id: r.component_id for r in simhash.near_duplicates(messy).collect()}
    assert near[2] == 1 and near[6] == 5 and 7 not in near
    assert simhash.near_duplicates(empty).isEmpty()


def test_quality_keeps_clean_text_and_rejects_junk(spark, messy, empty):
    rng = np.random.default_rng(1)
    common = [f"word{i}" for i in range(60)]
    clean = [" ".join(rng.choice(common, 80)) for _ in range(120)]
    junk = [" ".join(f"q{x}%%" for x in rng.integers(0, 10**9, 80)) for _ in range(20)]
    docs = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string"
    )
    labels = spark.createDataFrame(
        [(i, int(i < 120), 0) for i in range(100)] + [(3, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    found = {r.id: r.accepted for r in quality.classify(docs, labels).collect()}
    assert sum(found[i] for i in range(120)) >= 115
    assert not any(found[i] for i in range(120, 140))
    assert len(quality.classify(messy, labels).collect()) == len(ROWS)
    assert all(r.accepted for r in quality.classify(messy, labels.limit(0)).collect())
    assert quality.classify(empty, labels).isEmpty()


def test_packing(messy, empty):
    rows = packing.pack(messy, capacity=64).collect()
    lengths, bins = Counter(), defaultdict(list)
    for r in rows:
        lengths[r.id] += r.length
        bins[r.shard, r.bin].append(r)
    assert lengths[3] == lengths[4] == 1 and lengths[5] == 9001 and lengths[2] == 14
    for members in bins.values():
        assert sum(r.length for r in members) <= 64
        assert len({r.source for r in members}) == len(members)
    assert packing.pack(empty).isEmpty()


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(2)
    items = sorted(
        ((int(n), int(s), int(c)) for n, s, c in zip(rng.integers(1, 50, 300), rng.integers(0, 4, 300), rng.integers(0, 60, 300), strict=True)),
        reverse=True,
    )
    bins: list[list[tuple[int, int, int]]] = []
    expected = []
    for item in items:
        fits = [
            (64 - sum(x[0] for x in b), i)
            for i, b in enumerate(bins)
            if sum(x[0] for x in b) + item[0] <= 64
            and all(x[1] != item[1] and x[2] != item[2] for x in b)
        ]
        at = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[at].append(item)
        expected.append(at)
    assert [b for b, _ in packing.best_fit(items, 64)] == expected


def test_wavelet_answers_from_one_file():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 300, 3000).astype(np.uint32)
    ends = np.array([1000, 1000, 3000])
    file = wavelet.WaveletFile(wavelet.build(tokens, np.array([4, 0, 9]), np.array([False, True, False]), ends))
    assert (file.tokens() == tokens).all()
    assert [file.access(i) for i in (0, 511, 512, 2999)] == tokens[[0, 511, 512, 2999]].tolist()
    assert file.count(7, 100, 2000) == (tokens[100:2000] == 7).sum()
    assert file.occurrences(7) == np.flatnonzero(tokens == 7).tolist()
    assert file.count(9999) == 0 and file.documents()[2].tolist() == ends.tolist()


def test_wavelet_files_hold_what_the_tokenizer_gives(messy, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = wavelet.write_and_read(messy, path, shard_tokens=5000).orderBy("start").collect()
    tokenizer, at = Tokenizer.from_file(path), 0
    for row, (_, text, *_) in zip(rows, sorted(ROWS, key=lambda r: r[0] or 0), strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), crc)
        at += len(ids)
    assert wavelet.write_and_read(empty, path).isEmpty()


def test_fixity_audit(spark):
    pages = [(i, f"http://x/{i}", None if i == 3 else f"<p>{i}</p>" * 30) for i in range(120)]
    schema = "page_id long, url string, html string"
    rows = warc.write_and_audit(spark.createDataFrame([*pages, (None, None, "")], schema)).collect()
    assert {r.page_id for r in rows if not r.intact} == {7, 57, 107} and len(rows) == 121
    assert warc.write_and_audit(spark.createDataFrame([], schema)).isEmpty()


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(400, 16))
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16)]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + odd
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(dict)
    for r in knn.nearest(table, F.col("id") % 20 == 0).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 400, 20):
        exact = np.sqrt(np.square(points - points[q]).sum(axis=1))
        exact[q] = np.inf
        near = set(np.argsort(exact)[:10].tolist())
        assert len(found[q]) == 10
        assert all(abs(exact[v] - s) < 1e-12 for v, s in found[q].values())
        hits += len(near & {v for v, _ in found[q].values()})
    assert hits >= 0.9 * 200 and len(found) == 20
    assert knn.nearest(table.limit(0), F.lit(True)).isEmpty()


def test_unigram_counts(messy, empty):
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = {r.id: r.n_pieces for r in unigram.count_pieces(messy, model).collect()}
    assert found[3] == found[4] == 0 and found[1] >= 6
    small = unigram.Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)], -2.0)
    # Equal scores: the path whose last piece begins first wins; é is two bytes.
    assert small.text("ab") == (2, -3.0) and small.text("aé") == (3, -14.0)
    assert unigram.count_pieces(empty, model).isEmpty()


def test_hmm_scores(messy, empty):
    rows = hmm.score_texts(messy).collect()
    counts = Counter()
    for id_, text, *_ in ROWS:
        if zlib.crc32(str("" if id_ is None else id_).encode()) % 10:
            counts.update([*words(text), b""])
    n, v = sum(counts.values()), len(counts)
    texts = {id_: text for id_, text, *_ in ROWS}
    for r in rows:
        tokens = [*words(texts[r.id]), b""]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert r.train_tokens == n and r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isfinite(r.score)
    assert hmm.score_texts(empty).isEmpty()


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(4)
    pi, move, emit = (rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    sequences = [np.array(s, np.uint16) for s in ([0], [1, 4, 2], [3, 3])]
    packed = hmm.Packed(sequences)
    logs = packed.log10(packed.forward(pi, move, emit)[1])
    for sequence, log in zip(sequences, logs, strict=True):
        alpha = pi * emit[sequence[0]]
        for symbol in sequence[1:]:
            alpha = (alpha @ move) * emit[symbol]
        assert math.isclose(10**log, alpha.sum(), rel_tol=1e-12)


def test_expected_counts_equal_sums_over_all_paths():
    rng = np.random.default_rng(5)
    pi, move, emit = (rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(4), 2).T)
    for sequences in ([[0]], [[2], [1]], [[0], [1, 3, 2, 2], [3, 3], [1, 0, 1]]):
        first, moves, emissions = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
        for sequence in sequences:
            weights = {}
            for path in itertools.product(range(2), repeat=len(sequence)):
                weight = pi[path[0]] * emit[sequence[0], path[0]]
                for a, b, symbol in zip(path, path[1:], sequence[1:], strict=False):
                    weight *= move[a, b] * emit[symbol, b]
                weights[path] = weight
            total = sum(weights.values())
            for path, weight in weights.items():
                first[path[0]] += weight / total
                for a, b in itertools.pairwise(path):
                    moves[a, b] += weight / total
                for state, symbol in zip(path, sequence, strict=True):
                    emissions[state, symbol] += weight / total
        packed = hmm.Packed([np.array(s, np.uint16) for s in sequences])
        for found, plain in zip(packed.expected(pi, move, emit, 4), (first, moves, emissions), strict=True):
            assert np.allclose(found, plain, rtol=1e-12, atol=1e-14)


def _block_edits(rng) -> list[str]:
    """Texts with copies in which a passage was changed, added or cut."""
    texts = []
    for n in (15, 20, 40, 50, 100, 200, 300):
        for _ in range(6):
            base = [f"v{x}" for x in rng.integers(0, 10**6, n)]
            r = int(rng.integers(1, max(2, n // 11)))
            at = int(rng.integers(0, n - r))
            new = [f"n{x}" for x in rng.integers(0, 10**6, r)]
            for changed in (
                base,
                base[:at] + new + base[at + r :],
                base[:-r] + new,
                base + new,
                base[r:],
            ):
                texts.append(" ".join(changed))
    shared = " ".join(f"license{i}" for i in range(30))
    texts += [f"{shared} {' '.join(f'u{x}' for x in rng.integers(0, 10**6, 12))}" for _ in range(40)]
    return texts + ["same few words"] * 3 + ["a b c d e f"] * 2


def _plain_groups(texts: list[str], similarity: float = 0.8) -> dict[int, int]:
    """Components of all pairs by exact Jaccard similarity of shingles."""
    sets = [set(simhash.shingles(t, 5) or [b""]) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    size = Counter(label)
    return {i: x for i, x in enumerate(label) if size[x] > 1}


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = _block_edits(np.random.default_rng(11))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert found == _plain_groups(texts)


STAGE_SCHEMA = "doc_id long, text string, lang string, source string"


def test_exact_copies_leave_one_row_of_each_text(spark):
    rows = [
        (1, "same text", "en", "a"),
        (None, "Same text", "en", "a"),
        (None, "only here", "en", "a"),
        (None, "twice without id", "en", "a"),
        (None, "twice without id", "en", "b"),
        (2, "same text", "en", "a"),
        (2, "the other text of 2", "en", "a"),
        (3, "row again", "en", "a"),
        (3, "row again", "en", "a"),
    ]
    stay = exact_dedup.without_copies(spark.createDataFrame(rows, STAGE_SCHEMA)).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in stay) == [
        (0, "only here"),
        (0, "twice without id"),
        (1, "same text"),
        (2, "the other text of 2"),
        (3, "row again"),
    ]


def test_near_copies_are_dropped_by_row(spark):
    text = " ".join(f"p{i}" for i in range(60))
    rows = [
        (4, text, "en", "a"),
        (7, text + " end", "en", "a"),
        (7, "another text of the same id", "en", "a"),
        (None, text + " close", "en", "a"),
        (None, "a text of its own without id", "en", "a"),
        (8, "equal row", "en", "a"),
        (8, "equal row", "en", "a"),
    ]
    stay = simhash.without_near_copies(spark.createDataFrame(rows, STAGE_SCHEMA)).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in stay) == [
        (0, "a text of its own without id"),
        (4, text),
        (7, "another text of the same id"),
        (8, "equal row"),
    ]


def test_quality_rejects_by_row(spark):
    rng = np.random.default_rng(1)
    common = [f"word{i}" for i in range(60)]
    clean = [" ".join(rng.choice(common, 80)) for _ in range(120)]
    junk = " ".join(f"q{x}%%" for x in rng.integers(0, 10**9, 80))
    rows = [(i, t, "en", "a") for i, t in enumerate(clean)]
    rows += [(None, junk, "en", "a"), (None, clean[0], "en", "a"), (5, junk + " x", "en", "a")]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(20, 120)], "doc_id long, quality int, toxic int"
    )
    stay = quality.accepted(spark.createDataFrame(rows, STAGE_SCHEMA), labels).collect()
    assert [r.text for r in stay if r.doc_id is None] == [clean[0]]
    assert [r.text for r in stay if r.doc_id == 5] == [clean[5]]


def test_mixing_repeats_by_row(spark):
    # One id in three sources: each row takes the passes of its own source.
    rows = [(1, "a " * 300, "en", "a"), (1, "b " * 60, "en", "b"), (None, "c " * 60, "en", "c")]
    rows += [(None, "d " * 60, "en", "c"), (2, "e " * 30, "en", "b"), (2, "e " * 30, "en", "b")]
    docs = spark.createDataFrame(rows, STAGE_SCHEMA)
    taken = Counter()
    for r in mixing.mix(docs, carry=("text",)).collect():
        taken[r.text] += math.floor(r.taken / r.size + 0.5)
    found = Counter(r.text for r in mixing.mixed(docs).collect())
    assert found == +taken and len(set(taken.values())) > 1


def test_quality_rejects_toxic_documents(spark):
    rng = np.random.default_rng(6)
    common = [f"word{i}" for i in range(60)]
    texts = []
    for i in range(200):
        found = list(rng.choice(common, 120))
        if i >= 120:  # a few toxic words in an otherwise clean text
            for at in rng.integers(0, 120, 3):
                found[at] = f"insult{rng.integers(4)}"
        texts.append(" ".join(found))
    docs = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"
    )
    labels = spark.createDataFrame(
        [(i, 1, int(i >= 120)) for i in range(160)], "doc_id long, quality int, toxic int"
    )
    found = {r.id: r.accepted for r in quality.classify(docs, labels).collect()}
    assert sum(found[i] for i in range(120)) >= 112
    assert sum(not found[i] for i in range(160, 200)) >= 38


def test_quality_trains_on_every_trusted_text(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 800) % 5000) for _ in range(400)]
    docs = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"
    )
    labels = spark.createDataFrame(
        [(i, int(i < 300), 0) for i in range(390)], "doc_id long, quality int, toxic int"
    )
    trained = []
    train = quality.train

    def counted(chosen, scratch):
        trained.append(Counter(r.text for r in chosen.collect()))
        return train(chosen, scratch)

    monkeypatch.setattr(quality, "train", counted)
    found = {r.id: r.perplexity for r in quality.classify(docs, labels).collect()}
    trusted, bad = trained
    assert trusted <= Counter(texts[:300]) and trusted.total() >= 250  # less those held out
    assert bad == Counter(texts[300:390])
    monkeypatch.setattr(quality, "BLOCK", 1)
    again = {r.id: r.perplexity for r in quality.classify(docs, labels).collect()}
    assert again == pytest.approx(found, rel=1e-9)
    # The last document's perplexity from counts of all that was trained on.
    assert found[399] == pytest.approx(_perplexity(trusted, texts[399]), rel=1e-4)


def _perplexity(trained: Counter, text: str) -> float:
    """Interpolated modified Kneser-Ney, written plainly."""
    start, end = "<s>", "</s>"
    trigrams = Counter()
    for known, n in trained.items():
        tokens = [start, start, *known.split(), end]
        for gram in zip(tokens, tokens[1:], tokens[2:], strict=False):
            trigrams[gram] += n
    bigrams, unigrams = Counter(), Counter()
    for (_, b, c), n in trigrams.items():
        bigrams[b, c] += n if b == start else 1
    for _, c in bigrams:
        unigrams[(c,)] += 1
    orders = []
    for counts in (unigrams, bigrams, trigrams):
        cuts = quality._discounts(Counter(counts.values()))
        total, freed = Counter(), Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            freed[gram[:-1]] += cuts[min(n, 3) - 1]
        orders.append((counts, cuts, total, freed))
    # Starts are contexts, and so among the known words.
    size = len(unigrams) + 2

    def p(gram: tuple) -> float:
        counts, cuts, total, freed = orders[len(gram) - 1]
        lower = p(gram[1:]) if len(gram) > 1 else 1 / size
        n, context = counts[gram], gram[:-1]
        if not total[context]:
            return lower
        share = (n - cuts[min(n, 3) - 1]) / total[context] if n else 0.0
        return share + freed[context] / total[context] * lower

    tokens = [start, start, *text.split(), end]
    logs = [math.log(p(g)) for g in zip(tokens, tokens[1:], tokens[2:], strict=False)]
    return math.exp(-sum(logs) / len(logs))
