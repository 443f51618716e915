"""Keep one row per key.

`row_number() = 1` is written as a window and a filter. Spark then keeps one row per key in every
map task before the shuffle (WindowGroupLimit), so a key that holds a third of all rows reaches
its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in `order`. Give a total order to get the same row every time."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], at: str = "ingested_at", tie_break: Sequence[Column | str] = ()
) -> DataFrame:
    """The row ingested last; equal times are decided by `tie_break`."""
    return first_per_key(df, keys, [F.col(at).desc(), *tie_break])


def top_value_per_key(df: DataFrame, key: str, value: str, alias: str, weight: str | None = None) -> DataFrame:
    """Most frequent value of each key (or the one with most weight); the smaller value wins a tie.

    NULL counts as a value and loses ties.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(key, value).agg(size.alias("_n"))
    best = first_per_key(counts, [key], [F.col("_n").desc(), F.col(value).asc_nulls_last()])
    return best.select(key, F.col(value).alias(alias))
