"""One query for each operator, over its whole table, with production parameters; SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from capsieve.llm import ann, bpe, filter_audit, fingerprints, licenses, mixing, near_dup, packing, pii, quality, substring_dedup, vector_codes, warc
from capsieve.llm.store import text_batches

VOCABULARY = public_tokenizers.path(bpe.VOCABULARY)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, folder, "documents"))


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), VOCABULARY)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), VOCABULARY)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"), with_text=False)
    return found.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_likeness(_table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.scan(_table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.codes(_table(spark, folder, "embeddings"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_quality, op3_minhash_near_dedup, op4_nearest_neighbours, op5_bpe, op6_warc, op7_best_fit_packing,
    op8_substring_dedup, op9_fingerprints, op10_pii, op11_vector_codes, op12_filter_audit, op13_source_mix)}

SQL: dict[str, str] = {
    "op1_license_scan": licenses.sql(),
    "op6_warc": f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
payload AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM page),
first AS (SELECT payload_digest, min(page_id) AS page_id FROM payload WHERE payload_bytes >= {warc.LEAST_PAYLOAD} GROUP BY ALL)
SELECT p.page_id, payload_bytes, p.payload_digest, CASE WHEN f.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> p.page_id THEN f.page_id END AS refers_to
FROM payload p LEFT JOIN first f ON f.payload_digest = p.payload_digest""",
    "op8_substring_dedup": f"""
WITH word AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+'), []) AS w FROM documents),
place AS (SELECT doc_id, unnest(range(len(w) - {substring_dedup.WINDOW - 1})) AS s, w FROM word WHERE len(w) >= {substring_dedup.WINDOW}),
win AS (SELECT doc_id, s, array_to_string(w[s + 1:s + {substring_dedup.WINDOW}], ' ') AS words FROM place),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range({substring_dedup.WINDOW})) AS i FROM late),
each AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS i FROM word),
kept AS (SELECT doc_id, count(*) AS n, string_agg(t, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM word d LEFT JOIN kept USING (doc_id)""",
    "op11_vector_codes": vector_codes.sql(),
    "op12_filter_audit": filter_audit.SQL,
    "op13_source_mix": mixing.sql(),
}
