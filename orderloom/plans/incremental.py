"""Incremental tables: high watermark, overwrite of touched days, schema growth."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def high_watermark(target: DataFrame, column: str = "order_date", lookback_days: int = 0) -> Column:
    """Largest date already loaded, as a scalar subquery; `lookback_days` reopens that many days for late rows."""
    return target.agg(F.date_sub(F.max(column), lookback_days).alias("w")).scalar()


def newer_rows(source: DataFrame, target: DataFrame, column: str = "order_date", lookback_days: int = 0) -> DataFrame:
    """Source rows dated after the watermark. An empty target takes everything."""
    mark = high_watermark(target, column, lookback_days)
    return source.where(mark.isNull() | (F.col(column) > mark))


def replace_days(target: DataFrame, fresh: DataFrame, column: str = "order_date") -> DataFrame:
    """What the table holds after `fresh` has overwritten the days it contains."""
    kept = target.join(fresh.select(column).distinct(), column, "left_anti")
    return append_columns(kept, fresh)


def overwrite_days(fresh: DataFrame, path: str, column: str = "order_date", cluster: Sequence[str] = ()) -> None:
    """Dynamic partition overwrite: only the days in `fresh` are replaced on disk.

    The rebalance hint splits a day that holds much of the data and packs small days together.
    """
    (
        fresh.hint("rebalance", column)
        .sortWithinPartitions(column, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def append_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_incremental(
    spark: SparkSession,
    path: str,
    build: Callable[[Column | None], DataFrame],
    column: str = "order_date",
    cluster: Sequence[str] = (),
    full_refresh: bool = False,
    lookback_days: int = 0,
) -> None:
    """Build a mart table: everything on the first run or on a full refresh, else the new days.

    `build` receives the watermark (or None for everything). The watermark is one date; it is read once,
    so that the filter on the source is a literal that prunes partitions.
    """
    target = None if full_refresh else existing_table(spark, path)
    mark = None
    if target is not None:
        last = target.agg(F.date_sub(F.max(column), lookback_days)).first()[0]
        mark = None if last is None else F.lit(last)
    fresh = build(mark)
    if target is None:
        writer = fresh.hint("rebalance", column).sortWithinPartitions(column, *cluster).write
        # static whatever the session says: days that the fresh build lacks must go
        writer.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    else:
        overwrite_days(fresh, path, column, cluster)
