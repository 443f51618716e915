"""Sinks: JSON-lines parts, CSV, text lists, partitioned tables; and the selections that feed them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

PART_ROWS = 100_000


def export_parts(df: DataFrame, path: str, rows_per_part: int = PART_ROWS) -> None:
    """Gzipped JSON-lines files of at most `rows_per_part` rows."""
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_part).option(
        "compression", "gzip"
    ).json(path)


def of_types(df: DataFrame, column: str, types: Sequence[str]) -> DataFrame:
    if not types:
        raise ValueError("filtering by type needs at least one type")
    return df.where(F.col(column).isin(*types))


def after_key(df: DataFrame, key: str, last: object | None) -> DataFrame:
    """Rows behind the last exported key. The comparison reaches the file scan."""
    return df if last is None else df.where(F.col(key) > F.lit(last))


def export_stats(df: DataFrame, path: str | None = None) -> DataFrame:
    """Rows and uncompressed bytes (JSON plus line feed), and the compression ratio of files at `path`."""
    body = F.to_json(F.struct(*df.columns))
    stats = df.agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(F.octet_length(body) + 1), F.lit(0)).cast("bigint").alias("uncompressed_bytes"),
    )
    if path is None:
        return stats
    files = (
        df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).agg(
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
        )
    )
    compressed = files.scalar()
    ratio = (1 - compressed / F.col("uncompressed_bytes")) * 100
    return stats.withColumn("compressed_bytes", compressed).withColumn(
        "compression_ratio", F.when(F.col("uncompressed_bytes") > 0, ratio).otherwise(F.lit(0.0))
    )


def sample_of_types(df: DataFrame, column: str, types: Sequence[str], key: str, size: int) -> DataFrame:
    """A fixed-size, repeatable sample: the first rows by key of the chosen types."""
    return of_types(df, column, types).orderBy(key).limit(size)


def first_per_type(df: DataFrame, column: str | Sequence[str], key: Sequence[str | Column], size: int = 1) -> DataFrame:
    """The first `size` rows of every type (one column or several). Each map task is trimmed to `size` rows per type first."""
    columns = [column] if isinstance(column, str) else list(column)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*columns).orderBy(*key)))
    return ranked.where(F.col("_rank") <= size).drop("_rank")


def distinct_sorted(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct non-blank values in order."""
    values = df.select(column).where(F.col(column) != "").distinct().orderBy(column)
    return values if limit is None else values.limit(limit)


def write_text_list(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string")).write.mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return rows if limit is None else rows.limit(limit)


def write_partitioned(df: DataFrame, path: str, by: str, cluster: Sequence[str], mode: str = "overwrite") -> None:
    """Day-partitioned table, rows clustered inside files.

    The rebalance hint lets AQE split a day that holds much of the data and join small days,
    so no task writes a whole hot partition and no day is scattered over tiny files.
    """
    (
        df.hint("rebalance", by)
        .sortWithinPartitions(by, *cluster)
        .write.mode(mode)
        .partitionBy(by)
        .parquet(path)
    )
