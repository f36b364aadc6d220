"""The pipeline's stages: clashing columns, templates, repeated texts and a plain version."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from clickstrata.llm import exact_dedup, mixing, packing, quality, simhash
from clickstrata.llm.common import Scratch, words

CLASHES = "doc_id long, text string, lang string, source string, row string, n long, pass long, " \
    "rows long, best string, doc string, key string, node long, copies long"


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [
        (1, "one text", "en", "a"),
        (2, "one text", "en", "a"),
        (3, " ".join(f"w{i}" for i in range(40)), "en", "b"),
        (4, " ".join(f"w{i}" for i in range(41)), "en", "b"),
        (None, None, None, None),
    ]
    return spark.createDataFrame(
        [(*r, "own row", 5, 6, 7, "own best", "own doc", "own key", 8, 9) for r in rows], CLASHES
    )


@pytest.mark.parametrize("stage", ["quality", "exact", "near", "mixing"])
def test_columns_of_the_documents_survive(spark, clashing, stage):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    found = {
        "quality": lambda: quality.accepted(clashing, labels),
        "exact": lambda: exact_dedup.without_copies(clashing),
        "near": lambda: simhash.without_near_copies(clashing),
        "mixing": lambda: mixing.mixed(clashing),
    }[stage]()
    assert found.columns == clashing.columns
    rows = found.collect()
    assert rows and {tuple(r)[4:] for r in rows} == {tuple(clashing.first())[4:]}
    ids = {r.doc_id for r in rows}
    if stage in ("exact", "near"):
        assert ids == {"exact": {1, 3, 4, None}, "near": {1, 3, None}}[stage]


def _template(n: int, rng) -> list[str]:
    """Copies of one text, each with an edit of its own; no two of them are equal."""
    base = [f"t{i}" for i in range(60)]
    texts = []
    for i in range(n):
        words_ = list(base)
        words_[int(rng.integers(60))] = f"edit{i}"
        texts.append(" ".join(words_))
    return texts


def test_a_template_group_is_found_whole(spark):
    # Copies are similar only to those edited close by: links chain through the group.
    n = 2000
    texts = _template(n, np.random.default_rng(3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == n and {r.component_id for r in found} == {0}


@pytest.mark.xfail(reason="226 pairs by hubs, but 393,541 in the exact round; not mended")
def test_pairs_of_a_template_group_grow_with_its_size(spark, monkeypatch):
    asked = Counter()

    def counted(name):
        made = getattr(simhash, name)

        def of(*args):
            pairs = made(*args)
            asked[name] += pairs.count()
            return pairs

        monkeypatch.setattr(simhash, name, of)

    counted("star_pairs")
    counted("sharing_pairs")
    n = 2000
    texts = _template(n, np.random.default_rng(3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    simhash.near_duplicates(docs).collect()
    assert sum(asked.values()) <= 4 * n


def test_sketches_rule_out_no_similar_pair():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 300, 70_000):
        for share in (0.0, 0.05, 0.1, 0.3, 1.0):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            new = rng.integers(0, 2**63, max(1, int(share * n)), dtype=np.uint64)
            y = np.unique(np.concatenate([x[len(new) :], new]))
            both = len(np.intersect1d(x, y))
            if both >= 0.8 * (len(x) + len(y) - both):
                sketches = simhash.sketch(x), simhash.sketch(y)
                assert simhash.may_be_similar(*sketches, len(x) + len(y), 0.8)
    a, b = (np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64)) for _ in range(2))
    assert not simhash.may_be_similar(simhash.sketch(a), simhash.sketch(b), 200, 0.8)


def _plain_near(texts: dict[int, str]) -> set[int]:
    """Ids that stay: the smallest of each component at Jaccard 0.8 or more."""
    sets = {i: set(simhash.shingles(t, 5) or [b""]) for i, t in texts.items()}
    label = {i: i for i in texts}
    ids = sorted(texts)
    for at, i in enumerate(ids):
        for j in ids[:at]:
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((label[i], label[j]))
                label = {x: a if y == b else y for x, y in label.items()}
    return set(label.values())


def test_pipeline_stages_equal_plain_versions(spark, tmp_path):
    rng = np.random.default_rng(8)
    common = [f"word{i}" for i in range(300)]
    texts = [" ".join(rng.choice(common, int(rng.integers(30, 90)))) for _ in range(150)]
    texts += [texts[0].upper(), texts[1], texts[2] + " end", "more " + texts[3]]
    texts += [" ".join(f"q{x}%%" for x in rng.integers(0, 10**9, 60)) for _ in range(4)]
    rows = [(i, t, "en", "abc"[i % 3]) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(i, 1, 0) for i in range(10, 150)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.store(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        kept[name] = docs.collect()
    after = {name: {r.doc_id for r in found} for name, found in kept.items()}
    good, exact, near, mixed, packed = after.values()

    # What the classifier rejects is no more than a quantile of clean texts, and all junk.
    assert not good & set(range(154, 158)) and len(good) >= 148
    first = {}
    for i in sorted(good):
        first.setdefault(texts[i].lower(), i)
    assert exact == set(first.values())
    assert near == _plain_near({i: texts[i] for i in exact})

    # Sources a, b, c weigh 5, 2, 1; none passes three times its size.
    size = defaultdict(int)
    for i in near:
        size["abc"[i % 3]] += len(words(texts[i]))
    weight, target, left = {"a": 5, "b": 2, "c": 1}, {}, sum(size.values())
    while len(target) < 3:
        rest = {s: w for s, w in weight.items() if s not in target}
        full = [s for s in rest if left * rest[s] / sum(rest.values()) > 3 * size[s]]
        if not full:
            target |= {s: left * w / sum(rest.values()) for s, w in rest.items()}
        for s in full:
            target[s] = 3 * size[s]
        left = sum(size.values()) - sum(target[s] for s in target if s in full or target[s] == 3 * size[s])
    taken = Counter()
    for r in kept["mixing sources to target weights"]:
        taken[r.source] += len(words(r.text))
    for s in "abc":
        assert math.isclose(taken[s], target[s], abs_tol=90)
    assert mixed <= near and packed == mixed

    # All pieces are placed, none over another, and no bin holds a source twice.
    bins = defaultdict(list)
    for r in kept["best-fit packing"]:
        bins[r.shard, r.bin].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.position)
        ends = [0, *(r.position + r.length for r in held)]
        assert [r.position for r in held] == ends[:-1] and ends[-1] <= packing.CAPACITY
        assert len({r.source for r in held}) == len(held)
    copies = Counter(r.doc_id for r in kept["mixing sources to target weights"])
    placed = Counter()
    for r in kept["best-fit packing"]:
        placed[r.doc_id] += r.length
    assert placed == {i: n * (len(words(texts[i])) + 1) for i, n in copies.items()}
