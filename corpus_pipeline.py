"""From raw documents to a training mix: five stages, each an operator of `orderloom.llm` over all that is left.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet to the shared
scratch folder and reads it again, so a stage never recomputes the one before. All but the last return the columns of
`documents`. Empty inputs, nulls, repeated rows and extra columns pass through as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, jaccard_join, language_id, mixing, secret_scan
from orderloom.session import stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those that fit none of the learned languages."""
    return language_id.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by shingle sets of Jaccard similarity 0.8 or more, keep the smallest doc_id."""
    return jaccard_join.representatives(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the text; n_chars follows the text where there is one."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_passages),
    ("secret_scan", mask_secrets),
    ("mix", mix_sources),
]

#: The language stage is a learned kernel model, which SQL cannot express; tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
