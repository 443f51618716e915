"""Registered queries: each operator with production parameters over its whole table, and DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    arc_warc, collocations, decontaminate, discriminant, filter_audit, jaccard_join, language_id, mixing, oracles, pii, quality_rules, secret_scan, url_filter,
)
from orderloom.llm.substring_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.link_components(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(_table(spark, sf_dir, "documents")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal", "item_words")


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = arc_warc.round_trip(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("rule") == 0)).alias("kept"), F.col("rule").cast("long").alias("rule"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = discriminant.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_pii": op5_pii,
    "op6_source_mix": op6_source_mix,
    "op7_url_filter": op7_url_filter,
    "op8_decontaminate": op8_decontaminate,
    "op9_arc_to_warc": op9_arc_to_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_quality_discriminant": op13_quality_discriminant,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op2_jaccard_join": oracles.JACCARD_JOIN,
    "op7_url_filter": oracles.URL_FILTER,
    "op11_filter_audit": oracles.FILTER_AUDIT,
    "op12_collocations": oracles.COLLOCATIONS,
}
