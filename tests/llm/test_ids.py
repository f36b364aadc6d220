"""Ids beyond 2^53 keep their value beside a null in the same batch."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import hmm, packing, unigram, warc, wavelet

IDS = [2**53 + 1, 2**53 + 3, None, 2**63 - 1, -(2**63), 0]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text number {n} of six", "s") for n, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)


def found(df, column="id"):
    return sorted((r[column] for r in df.collect()), key=lambda i: (i is None, i or 0))


EXPECTED = sorted(IDS, key=lambda i: (i is None, i or 0))


def test_token_counts(docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert found(unigram.count_pieces(docs, model)) == EXPECTED


def test_packing(docs):
    packed = packing.pack(docs)
    assert found(packed) == EXPECTED
    # Equal lengths: ids decide, the null one last.
    order = [r.id for r in packed.orderBy("bin").collect()]
    assert order == EXPECTED


def test_token_files(docs):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    rows = wavelet.write_and_read(docs, tokenizer).orderBy("start").collect()
    assert [r.id for r in rows] == [None, *EXPECTED[:-1]]


def test_scores(docs):
    assert found(hmm.score_texts(docs)) == EXPECTED


def test_warc(docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert found(warc.write_and_audit(pages), "page_id") == EXPECTED
