"""Samples of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.cleaning import percent
from orderloom.sources.exports import first_per_type


def random_rows(df: DataFrame, size: int, key: Sequence[str], seed: int = 0, weight: Column | None = None) -> DataFrame:
    """`size` random rows without replacement: the same ones for the same seed, however the rows are spread.

    A weighted reservoir in one pass: every row draws ln(u) / weight with u from a hash of the seed and its `key`, and the
    largest draws win. Each task keeps its `size` best, and the best of these are merged, so nothing is sorted as a
    whole. A row's chance grows with its weight (1 if none is given); rows with a null weight, or one that is not
    positive, are never drawn. Rows that share a key draw the same number.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    drawn = df.withColumn("_draw", F.when(weight > 0, F.log(u) / weight)).where("_draw is not null")
    return drawn.orderBy(F.col("_draw").desc(), *key).limit(size).drop("_draw")


def repeatable_rows(df: DataFrame, size: int, key: Sequence[str]) -> DataFrame:
    """`size` rows spread evenly by the hash of a key: the same rows on every run."""
    return df.orderBy(F.md5(F.concat_ws("|", *key)), *key).limit(size)


def matching_rows(df: DataFrame, condition: Column, size: int, order: Sequence[str]) -> DataFrame:
    """The first `size` rows that satisfy a condition."""
    return df.where(condition).orderBy(*order).limit(size)


def stratified(df: DataFrame, column: str, size: int, order: Sequence[str | Column]) -> DataFrame:
    """Up to `size` rows of every value of `column`."""
    return first_per_type(df, column, order, size)


def offending_sample(df: DataFrame, condition: Column, size: int, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first `size` rows that satisfy `condition`, each with the table's rows, the offending ones and their share."""
    stats = df.agg(F.struct(F.count("*").alias("rows"), F.count_if(condition).alias("bad")).alias("s")).scalar()
    share = percent(F.col("_s.bad"), F.col("_s.rows"))
    sample = matching_rows(df, condition, size, order).withColumn("_s", stats)
    return sample.select(F.col("_s.rows").alias("total_rows"), F.col("_s.bad").alias("offending_rows"), share.alias("offending_pct"), *columns)
