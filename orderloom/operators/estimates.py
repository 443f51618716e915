"""Counts that need no full scan: rows from file footers, distinct values from stored daily sketches.

A sketch of a day and column has a few kilobytes whatever the day holds. Sketches merge, so the distinct values of any
span of days, or of a table that grows day by day, come from the stored sketches; only new days are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**12 registers. The standard error of merged sketches is 1.04 / 2**6.
LG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)
#: An estimate is off by more than this share about once in 15,000 times.
ERROR_BOUND = 4 * STANDARD_ERROR


def footer_rows(df: DataFrame) -> int:
    """Rows of a table of Parquet files. No column is read: the readers take the count from the files' footers."""
    return df.select().count()


def daily_sketches(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """(day, column_name, rows, filled, sketch): one row per day and column, combined on the map side.

    Values are compared as text. Rows without a day have a row of their own.
    """
    aggregates = []
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`").cast("string")
        aggregates += [F.hll_sketch_agg(text, LG_REGISTERS).alias(f"s{i}"), F.count(text).alias(f"f{i}")]
    days = df.groupBy(day.alias("day")).agg(F.count("*").alias("rows"), *aggregates)
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"f{i}").alias("filled"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return days.select("day", "rows", F.explode(each).alias("e")).select("day", "e.column_name", "rows", "e.filled", "e.sketch")


def new_days(sketches: DataFrame, df: DataFrame, day: Column) -> DataFrame:
    """Rows of `df` whose day has no sketches yet."""
    known = sketches.select(F.col("day").alias("_known")).distinct()
    return df.withColumn("_day", day).join(known, F.col("_day").eqNullSafe(F.col("_known")), "left_anti").drop("_day")


def merged_counts(sketches: DataFrame) -> DataFrame:
    """(column_name, rows, filled, distinct_estimate) over all given days; see ERROR_BOUND."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    )
    return merged.withColumn("distinct_estimate", F.coalesce("distinct_estimate", F.lit(0)).cast("bigint"))
