"""Load every newly arrived gzipped JSON-lines file into the raw table its path names."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.sources.jsonl import parse_lines, split_rejected
from orderloom.sources.routing import RAW_TABLES

#: Delivered files (.jsonl.gz) and parts that `export_parts` writes (.json.gz).
PATTERN = "*.json*.gz"


def read_new_lines(
    spark: SparkSession, root: str, table: str, files_per_batch: int = 1000, pattern: str = PATTERN
) -> DataFrame:
    """Stream of the lines of one raw table. Only its own folder is listed, so other files are never read."""
    return (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{root.rstrip('/')}/raw/{table}")
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
    )


def autoload(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    tables: Sequence[str] = RAW_TABLES,
    strict: bool = True,
    files_per_batch: int = 1000,
    pattern: str = PATTERN,
    quarantine: bool = False,
) -> list[StreamingQuery]:
    """Load all files that have not been loaded yet, then stop (run it again for later files).

    One query per table that has a folder. Each micro-batch writes its own `load_batch` partition, and a
    batch that is repeated after a failure overwrites that partition: every file is loaded exactly once.
    Partitions carry the id that the checkpoint gives the query, so a new checkpoint never overwrites old loads.
    With `quarantine`, lines that are no JSON objects go to `rejected/<table>` below the target instead of stopping
    the load; see `rejected_table`.
    """

    def writer(table: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            lines = batch.select("line")
            query = json.loads(spark.read.text(f"{checkpoint}/{table}/metadata").first()[0])["id"]
            part = f"load_batch={query}-{batch_id}"
            if quarantine:
                lines, bad = split_rejected(lines)
                bad.write.mode("overwrite").parquet(f"{target}/rejected/{table}/{part}")
            parse_lines(lines, table, strict=strict).write.mode("overwrite").parquet(f"{target}/{table}/{part}")

        return write

    queries = []
    for table in tables:
        try:
            lines = read_new_lines(spark, root, table, files_per_batch, pattern)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # no file of this table has arrived yet
        queries.append(
            lines.writeStream.foreachBatch(writer(table))
            .option("checkpointLocation", f"{checkpoint}/{table}")
            .trigger(availableNow=True)
            .start()
        )
    return queries


def loaded_table(spark: SparkSession, target: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{target}/{table}").drop("load_batch")


def rejected_table(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Lines set aside by `autoload(quarantine=True)`."""
    return spark.read.schema("line string").parquet(f"{target}/rejected/{table}").drop("load_batch")


def drop_redelivered(events: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within `delay`; older state is forgotten, so it stays bounded."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
