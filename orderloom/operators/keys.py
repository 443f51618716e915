"""Surrogate keys 1..n in a global order, without sorting everything in one task and without storing the rows.

A sample of the order columns gives the borders of buckets, once, as literals of the plan. From then on the bucket of a
row is a function of the row: whenever a task is repeated, its rows fall into the same buckets again. One narrow pass
counts the rows of each bucket; a row's number is its place inside the bucket plus the rows of all earlier buckets. The
rows themselves move once, to their buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 2
#: Rows of the sample per bucket: the largest bucket is seldom more than one and a half times the mean.
SAMPLE_PER_BUCKET = 40


def bucket_of(df: DataFrame, order: Sequence[str], buckets: int | None = None) -> Column:
    """Number of the range that a row of `df` falls into, from 0; monotone in `order`, nulls first.

    The sample is the rows with the smallest hashes of their order columns: the same on every run, bounded by the number
    of buckets, and only the order columns are read for it. The borders are one literal array, searched by halving: the
    code that Spark makes for it is the same for any number of buckets.
    """
    n = buckets or BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = list(order)
    sample = df.select(*names).orderBy(F.xxhash64(*names), *names).limit(n * SAMPLE_PER_BUCKET)
    rows = sample.orderBy(*names).collect()
    borders = [rows[i * len(rows) // n] for i in range(1, n) if rows] if len(rows) > n else rows
    if not borders:
        return F.lit(0)
    types = [df.schema[c].dataType for c in names]

    def literal(row: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, types, names, strict=True)])

    row, ends = F.struct(*names), F.array(*[literal(b) for b in borders])
    steps = F.array(*[F.lit(2**i) for i in reversed(range(len(borders).bit_length()))])
    # the borders that do not lie behind the row; a step past the last border compares with NULL and is not taken
    return F.aggregate(steps, F.lit(0), lambda low, step: low + F.when(row >= F.get(ends, low + step - 1), step).otherwise(0))


def bucket_offsets(placed: DataFrame, order: Sequence[str], following: Sequence[str] = ()) -> DataFrame:
    """Rows of all earlier buckets for each `_bucket` of `placed`, and what the next bucket begins with."""
    # one row per bucket: bounded by the number of buckets
    first = [F.min_by(F.struct(*following), F.struct(*order)).alias("_first")] if following else []
    offsets = placed.groupBy("_bucket").agg(F.count("*").alias("_size"), *first)
    earlier = Window.orderBy("_bucket")
    more = [F.lead("_first").over(earlier).alias("_first")] if following else []
    return offsets.select("_bucket", (F.sum("_size").over(earlier) - F.col("_size")).alias("_before"), *more)


def number_in_buckets(
    placed: DataFrame, offsets: DataFrame, order: Sequence[str], name: str = "_index", following: Sequence[str] = ()
) -> DataFrame:
    """Number the rows of `placed` by `_bucket` and `order`, behind the rows that `offsets` counts; `_bucket` goes."""
    inside = Window.partitionBy("_bucket").orderBy(*order)
    numbered = placed.withColumn("_place", F.row_number().over(inside))
    if following:
        numbered = numbered.withColumn("_next", F.lead(F.struct(*following)).over(inside))
    out = numbered.join(F.broadcast(offsets), "_bucket").withColumn(name, F.col("_before") + F.col("_place"))
    if following:
        out = out.withColumn("_next", F.coalesce("_next", "_first")).drop("_first")
    return out.drop("_bucket", "_place", "_before")


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "_index", following: Sequence[str] = ()) -> DataFrame:
    """Add 1, 2, 3, … in `order`, and `_next`: the columns `following` of the next row, null for the last one.

    `order` should tell rows apart: rows that tie are numbered in any order and share a bucket. Give a stored table when
    `df` is dear to compute, as it is evaluated three times (twice for the order columns only).
    """
    names = list(order)
    bucket = bucket_of(df, names)
    narrow = df.select(*dict.fromkeys([*names, *following])).withColumn("_bucket", bucket)
    return number_in_buckets(df.withColumn("_bucket", bucket), bucket_offsets(narrow, names, following), names, name, following)


def add_surrogate_key(df: DataFrame, name: str, order: Sequence[str], start_after: int | Column = 0) -> DataFrame:
    """Prepend a dense key column that continues behind `start_after`."""
    base = F.lit(start_after) if isinstance(start_after, int) else start_after
    indexed = with_row_index(df, order)
    return indexed.select((F.col("_index") + base).cast("bigint").alias(name), *df.columns)


def add_small_surrogate_key(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Same numbers for a table whose size is bounded by its domain (device classes, currencies)."""
    w = Window.orderBy(*order)
    return df.select(F.row_number().over(w).cast("bigint").alias(name), *df.columns)


def max_key(df: DataFrame, name: str) -> Column:
    """Largest existing key as a scalar subquery; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("k")).scalar()


def with_unknown_members(df: DataFrame, members: DataFrame) -> DataFrame:
    """Put the fixed members (-1 unknown, -2 not applicable) in front of a dimension."""
    return members.unionByName(df)
