"""Which raw table a file belongs to, and which files make up a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW_TABLES = ("events", "ip_locations", "products")


def raw_glob(root: str, table: str, date: str | None = None) -> str:
    """Glob of the gzipped JSON-lines files of one table: all (exported parts too), or those named after one yyyymmdd date."""
    if table not in RAW_TABLES:
        raise ValueError(f"no raw table named {table!r}")
    if date is None:
        return f"{root.rstrip('/')}/raw/{table}/*.json*.gz"
    stem = f"{table}_{date}"
    if table == "events":
        stem += "_part*"
    return f"{root.rstrip('/')}/raw/{table}/{stem}.jsonl.gz"


def table_of_path(path: Column | str) -> Column:
    """Table of a path relative to the bucket root; NULL when it is not a raw file."""
    text = F.col(path) if isinstance(path, str) else path
    branches = None
    for table in RAW_TABLES:
        hit = text.startswith(f"raw/{table}/")
        branches = F.when(hit, table) if branches is None else branches.when(hit, table)
    return branches


def relative_path(full: Column | str, root: str) -> Column:
    """Path below the bucket root, without scheme."""
    text = F.col(full) if isinstance(full, str) else full
    marker = root.split("://", 1)[-1].strip("/") + "/"
    return F.substring_index(text, marker, -1)


def validate_load(df: DataFrame) -> DataFrame:
    """One row: rows, first and last ingestion, ingestion dates, and whether anything was loaded."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.min("ingested_at").alias("earliest_ingestion"),
        F.max("ingested_at").alias("latest_ingestion"),
        F.count_distinct(F.to_date("ingested_at")).alias("distinct_ingestion_dates"),
    ).withColumn("has_rows", F.col("total_rows") > 0)
