"""The registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricspark.llm.bpe import bpe_digests
from metricspark.llm.chunks import fingerprint_result
from metricspark.llm.collocations import collocations
from metricspark.llm.common import table
from metricspark.llm.conversations import conversation_result
from metricspark.llm.jaccard import jaccard_components
from metricspark.llm.mixing import mix_result
from metricspark.llm.pii import pii_result
from metricspark.llm.prefixes import token_counts_result
from metricspark.llm.quality import quality_result
from metricspark.llm.topk import top_k
from metricspark.llm.toxicity import toxicity_result
from metricspark.llm.warc import warc_result
from metricspark.llm.wavelet import wavelet_result


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet_result(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op3_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_result(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_result(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_result(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_result(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_result(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_result(table(spark, sf_dir, "documents"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_result(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts_result(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_wavelet,
        op2_topk,
        op3_chunks,
        op4_jaccard,
        op5_bpe,
        op6_toxicity,
        op7_pii,
        op8_warc,
        op9_quality,
        op10_mixing,
        op11_conversations,
        op12_collocations,
        op13_token_counts,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op8_warc": """
        WITH paid AS (
            SELECT page_id, coalesce(html, '') AS html,
                   octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
            FROM pages),
        grouped AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                           THEN max(page_id) OVER (PARTITION BY html) END AS first
            FROM paid)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM grouped
    """,
    "op10_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   CASE WHEN text IS NULL THEN 0
                        ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS mix_key
            FROM documents),
        totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                          WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
            FROM totals),
        levels AS (
            SELECT *, source_size / weight AS ratio,
                   (sum(source_size) OVER () * 1.5::DOUBLE
                    - coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM weighed),
        common AS (
            SELECT level FROM levels WHERE level * weight <= 2 * source_size ORDER BY ratio, level LIMIT 1),
        targets AS (
            SELECT source, source_size,
                   least((2 * source_size)::DOUBLE, coalesce((SELECT level FROM common), 0.0) * weight) AS target
            FROM levels),
        placed AS (
            SELECT doc_id, size, source_size, target,
                   sum(size) OVER (PARTITION BY source ORDER BY mix_key, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS earlier,
                   CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
            FROM sized JOIN targets USING (source))
        SELECT doc_id, size, source_size, target,
               (size * (epochs + CASE WHEN earlier + size / 2 <= target - epochs * source_size
                                       AND target - epochs * source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM placed
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
        grams AS (
            SELECT lang, size,
                   unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size)
            WHERE len(w) >= size),
        known AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                   array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
            FROM known, (SELECT unnest([1, 2, 3]) AS k)
            WHERE k < size),
        scored AS (
            SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r,
                   ((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f))::BIGINT AS score
            FROM cuts c
            JOIN known x ON x.lang = c.lang AND x.phrase = c.head
            JOIN known y ON y.lang = c.lang AND y.phrase = c.rest),
        weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM weakest w
            WHERE NOT EXISTS (
                SELECT 1 FROM known b
                WHERE b.lang = w.lang AND b.size > w.size AND 100 * b.f >= 80 * w.a
                  AND contains(' ' || b.phrase || ' ', ' ' || w.phrase || ' '))),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
