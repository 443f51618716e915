"""Data checks. Each returns the offending rows; no rows means the check holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """unique: values that occur more than once."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """not_null: rows without a value."""
    return df.where(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """accepted_values: other values with their counts."""
    rows = df.where(~F.col(column).isin(*accepted))
    return rows.groupBy(column).agg(F.count("*").alias("n_records"))


def orphans(df: DataFrame, column: str, parent: DataFrame, field: str, allowed: Sequence = ()) -> DataFrame:
    """relationships: distinct keys that have no parent; `allowed` lists agreed exceptions."""
    keys = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    if allowed:
        keys = keys.where(~F.col(column).isin(*allowed))
    return keys.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def not_exactly_one_current(history: DataFrame, key: str = "customer_natural_key") -> DataFrame:
    """Keys with no or several current versions."""
    counts = history.groupBy(key).agg(F.count_if(F.col("is_current")).alias("current_count"))
    return counts.where(F.col("current_count") != 1)


def inverted_ranges(history: DataFrame) -> DataFrame:
    """Versions that end before they start."""
    return history.where(F.col("valid_to") < F.col("valid_from"))


def run_checks(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per named check: how many rows violate it and whether it passed."""
    result = None
    for name, rows in checks.items():
        one = rows.agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("check_name"), "violations", (F.col("violations") == 0).alias("passed")
        )
        result = one if result is None else result.unionByName(one)
    return result
