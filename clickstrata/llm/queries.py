"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm import (
    collocations,
    exact_dedup,
    hmm,
    knn,
    mixing,
    packing,
    quality,
    resample,
    simhash,
    topk,
    unigram,
    warc,
    wavelet,
)
from clickstrata.llm.common import LOWER, UPPER, table


def op1_hmm_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = hmm.score_texts(table(spark, folder, "documents"))
    return scored.withColumnRenamed("id", "doc_id")


def op2_wavelet_ids(
    spark: SparkSession, folder: str, tokenizer: str | None = None
) -> DataFrame:
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    stored = wavelet.write_and_read(table(spark, folder, "documents"), tokenizer)
    return stored.withColumnRenamed("id", "doc_id")


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"))
    return packed.withColumnRenamed("id", "doc_id")


def op4_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    audited = warc.write_and_audit(pages)
    return audited.select("page_id", "payload_sha256", "payload_bytes", "intact")


def op5_one_bit_knn(spark: SparkSession, folder: str) -> DataFrame:
    return knn.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op6_unigram_counts(
    spark: SparkSession, folder: str, model: str | None = None
) -> DataFrame:
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    counted = unigram.count_pieces(table(spark, folder, "documents"), model)
    return counted.withColumnRenamed("id", "doc_id")


def op7_simhash_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    linked = simhash.simhash_components(table(spark, folder, "documents"))
    return linked.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = exact_dedup.exact_dedup(table(spark, folder, "documents"), keep="largest")
    return decided.withColumnRenamed("id", "doc_id")


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.classify(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return judged.withColumnRenamed("id", "doc_id")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.withColumnRenamed("id", "doc_id")


def op11_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    found = topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resample.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hmm_score": op1_hmm_score,
    "op2_wavelet_ids": op2_wavelet_ids,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_warc_fixity": op4_warc_fixity,
    "op5_one_bit_knn": op5_one_bit_knn,
    "op6_unigram_counts": op6_unigram_counts,
    "op7_simhash_near_dup": op7_simhash_near_dup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_mixing": op10_mixing,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc_fixity": """
        SELECT page_id,
               sha256(coalesce(html, '')) AS payload_sha256,
               octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               page_id % 50 <> 7 AS intact
        FROM pages
    """,
    "op8_exact_dedup": f"""
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(body) AS text_sha256
        FROM texts
        WINDOW same AS (PARTITION BY body)
    """,
    "op11_exact_top_k": """
        WITH whole AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.row, q.vec_id AS query_id, c.vec_id, c.row AS other,
                   list_dot_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.row <> c.row AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
        FROM scored
        WINDOW best AS (
            PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST, other
        )
        QUALIFY row_number() OVER best <= 20
    """,
    "op12_importance_resampling": rf"""
        WITH crc_table AS (
            SELECT list_transform(
                range(256),
                lambda b: list_reduce(
                    [b] || list_transform(range(8), lambda i: i),
                    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
                )
            ) AS t
        ),
        spelled AS (
            SELECT 'doc' AS kind, row_number() OVER () AS row, doc_id AS id,
                   list_filter(
                       string_split_regex(
                           translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'
                       ),
                       lambda w: w <> ''
                   ) AS w
            FROM documents
            UNION ALL
            SELECT 'aim', row_number() OVER (), NULL,
                   list_filter(
                       string_split_regex(
                           translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'
                       ),
                       lambda w: w <> ''
                   )
            FROM benchmark
        ),
        features AS (
            SELECT kind, row, unnest(w) AS feature FROM spelled
            UNION ALL
            SELECT kind, row,
                   unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
            FROM spelled WHERE len(w) > 1
        ),
        hashed AS (
            SELECT feature,
                   xor(list_reduce(
                       [4294967295] || list_transform(
                           range(octet_length(encode(feature))),
                           lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT
                       ),
                       lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT])
                   ), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT feature FROM features), crc_table
        ),
        counted AS (
            SELECT bucket, count(*) FILTER (kind = 'doc') AS s, count(*) FILTER (kind = 'aim') AS t
            FROM features JOIN hashed USING (feature) GROUP BY bucket
        ),
        gains AS (
            SELECT bucket,
                   floor(1000 * ln(
                       ((t + 1) * (of + 10000))::DOUBLE / ((s + 1) * (aim + 10000))::DOUBLE
                   ))::BIGINT AS gain
            FROM counted, (SELECT sum(s)::BIGINT AS of, sum(t)::BIGINT AS aim FROM counted)
        ),
        weights AS (
            SELECT row, count(*) AS n, sum(gain)::BIGINT AS total
            FROM features JOIN hashed USING (feature) JOIN gains USING (bucket)
            WHERE kind = 'doc' GROUP BY row
        ),
        scored AS (
            SELECT id AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
                   coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
                   floor(-1000 * ln(-ln(
                       (('0x' || left(sha256('7:' || coalesce(id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296::DOUBLE
                   )))::BIGINT AS luck
            FROM spelled LEFT JOIN weights USING (row) WHERE kind = 'doc'
        ),
        ranked AS (
            SELECT *, weight + luck AS score,
                   row_number() OVER (
                       PARTITION BY words >= 20
                       ORDER BY weight + luck DESC, doc_id NULLS LAST, n_features, weight
                   ) AS place
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN words >= 20
                         AND place <= (SELECT count(*) FROM scored WHERE words >= 20) * 25 // 100
                    THEN place END AS rank
        FROM ranked
    """,
    "op13_collocations": rf"""
        WITH pieces AS (
            SELECT lang,
                   list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(string_split_regex(
                           translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                           '[.,;:!?\x0A-\x0D]'
                       )) AS piece
                FROM documents
            )
        ),
        runs AS (
            SELECT lang, 1 AS words, unnest(w) AS phrase FROM pieces
            UNION ALL
            SELECT lang, 2,
                   unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
            FROM pieces WHERE len(w) > 1
            UNION ALL
            SELECT lang, 3, unnest(list_transform(
                       range(1, len(w) - 1),
                       lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                   ))
            FROM pieces WHERE len(w) > 2
        ),
        counts AS MATERIALIZED (
            SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY ALL
        ),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
        candidates AS (
            SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w
            FROM counts WHERE words > 1 AND f >= 10
        ),
        cuts AS (
            SELECT lang, phrase, a, k,
                   array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)
        ),
        scored AS (
            SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
                   ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM cuts c
            JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
            JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
        ),
        longer AS (
            SELECT lang, phrase, max(a) AS most FROM (
                SELECT lang, array_to_string(w[:2], ' ') AS phrase, a
                FROM candidates WHERE words = 3
                UNION ALL
                SELECT lang, array_to_string(w[2:], ' '), a FROM candidates WHERE words = 3
            ) GROUP BY ALL
        )
        SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
        FROM scored JOIN totals USING (lang) LEFT JOIN longer USING (lang, phrase)
        WHERE most IS NULL OR 100 * most < 50 * a
        WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
        QUALIFY row_number() OVER best <= 2000
    """,
}
