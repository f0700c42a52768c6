"""The registered queries over the corpus tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import audio, bpe, fertility, html_extract, licenses, packing, sharding, simhash, substrings, warc
from .shared import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op2_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table has recordings: each vector is rendered as a melody first."""
    return audio.searched(audio.rendered(table(spark, sf_dir, "embeddings")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rated(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_chroma": op2_chroma,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_fertility": op4_fertility,
    "op5_simhash": op5_simhash,
    "op6_bpe": op6_bpe,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        r AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
                     min(page_id) OVER (PARTITION BY sha256(html)) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM r
    """,
}
