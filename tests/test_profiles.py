"""Estimates, samples, nested schemas and declared checks."""

from collections import Counter
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import estimates, sampling, structure
from orderloom.session import scratch_path
from orderloom.sources import schemas


def test_footer_rows_read_no_column(spark):
    path = scratch_path(spark)
    spark.range(5000).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    assert estimates.footer_rows(df) == 5000
    plan = df.select().groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_daily_sketches_merge_and_keep_to_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("d"), (F.col("id") % 9000).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"))
    df = df.unionByName(spark.createDataFrame([(None, 1, None)], "d long, a long, b long"))
    first = estimates.daily_sketches(df.where("d < 3"), F.col("d"), ["a", "b"])
    later = estimates.daily_sketches(estimates.new_days(first, df, F.col("d")), F.col("d"), ["a", "b"])
    assert later.where("d is null" if "d" in later.columns else "day is null").count() == 2 and later.where("day < 3").count() == 0
    got = {r.column_name: r for r in estimates.merged_counts(first.unionByName(later)).collect()}
    assert (got["a"].rows, got["a"].filled, got["b"].filled) == (60_001, 60_001, 30_000)
    for name, exact in (("a", 9000), ("b", 30_000)):
        assert abs(got[name].distinct_estimate - exact) <= estimates.ERROR_BOUND * exact
    assert estimates.merged_counts(first.where("day > 99")).count() == 0


def test_random_rows_have_the_size_and_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = rows(sampling.random_rows(df, 50, ["id"], 3))
    assert len(one) == 50 and one == rows(sampling.random_rows(df.repartition(13), 50, ["id"], 3))
    assert one != rows(sampling.random_rows(df, 50, ["id"], 4))
    assert sampling.random_rows(df, 5000, ["id"]).count() == 1000 and sampling.random_rows(df.where("id < 0"), 5, ["id"]).count() == 0


def test_random_rows_are_even_and_follow_weights(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 20, 1.0).otherwise(3.0).alias("w"))
    even, weighted = Counter(), Counter()
    seeds = 250
    for seed in range(seeds):
        even.update(r.id for r in sampling.random_rows(df, 10, ["id"], seed).collect())
    for seed in range(seeds):
        weighted.update(r.id >= 20 for r in sampling.random_rows(df, 1, ["id"], seed, F.col("w")).collect())
    assert len(even) == 40 and sum((even[i] - seeds / 4) ** 2 / (seeds * 3 / 16) for i in range(40)) < 80  # chi-square, 39 degrees
    assert 0.66 < weighted[True] / seeds < 0.84  # three quarters of the weight
    odd = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, -1.0), (4, None)], "id long, w double")
    assert [r.id for r in sampling.random_rows(odd, 9, ["id"], 1, F.col("w")).collect()] == [1]


def test_nested_columns_at_any_depth(spark):
    schema = "a long, s struct<b:string,c:struct<d:long>>, l array<struct<e:array<struct<f:string>>,g:long>>, n array<array<long>>"
    data = [(1, ("x", (5,)), [([("p",), (None,)], 1), (None, None)], [[1, 2], None, []]), (None, None, [], None), (2, ("", None), None, [])]
    got = {r.path: r for r in structure.nested_columns(spark.createDataFrame(data, schema), "t").collect()}
    assert list(got) == ["a", "s", "s.b", "s.c", "s.c.d", "l", "l[].e", "l[].e[].f", "l[].g", "n"]
    assert {p: (r.depth, r.field_mode, r.filled_values, r["sample"]) for p, r in got.items()} == {
        "a": (1, "SCALAR", 2, "1"), "s": (1, "RECORD", 2, None), "s.b": (2, "SCALAR", 2, ""), "s.c": (2, "RECORD", 1, None), "s.c.d": (3, "SCALAR", 1, "5"),
        "l": (1, "REPEATED", 1, None), "l[].e": (2, "REPEATED", 1, None), "l[].e[].f": (3, "SCALAR", 1, "p"), "l[].g": (2, "SCALAR", 1, "1"), "n": (1, "REPEATED", 1, None),
    }
    one = structure.column_summary(spark.createDataFrame(data, schema), "t").first()
    assert (one.total_columns, one.nullable_columns, one.nested_columns, one.total_fields) == (4, 4, 3, 10)


def test_declared_checks(spark):
    source = schemas.Source({"k": ("unique", "not_null"), "v": ("not_null",)}, "at", 3)
    day = lambda d: datetime(2024, 1, d)
    df = spark.createDataFrame([("a", 1, day(1)), ("a", None, day(2)), (None, None, day(2)), ("b", 3, None), (None, 1, day(1))], "k string, v long, at timestamp")
    now = F.to_timestamp(F.lit("2024-01-09 10:00:00"))
    got = {(r.column_name, r.test): (r.failing, r.passed) for r in schemas.check_declared(df, "t", now, source).collect()}
    assert got == {("k", "unique"): (1, False), ("k", "not_null"): (2, False), ("v", "not_null"): (2, False), ("at", "fresh"): (4, False)}
    none = schemas.check_declared(df.where("k = 'zz'"), "t", now, source)
    assert {(r.test, r.failing) for r in none.collect()} == {("unique", 0), ("not_null", 0), ("fresh", 1)}


def test_offending_sample(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "n") for i in range(20)], "id long, name string")
    got = sampling.offending_sample(df, F.col("name").isNull(), 3, ["id"], ["id"]).collect()
    assert [tuple(r) for r in got] == [(20, 5, 25.0, 0), (20, 5, 25.0, 4), (20, 5, 25.0, 8)]
    assert sampling.offending_sample(df, F.col("id") < 0, 3, ["id"], ["id"]).count() == 0
