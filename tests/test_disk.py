"""What large steps leave on disk, and lookups that come to the lines."""

import os
import time
from datetime import date, datetime
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from orderloom.catalog import star as catalog
from orderloom.operators.lookups import asked_for, join_in_buckets
from orderloom.plans import core, intermediate
from orderloom.plans.warehouse import Model, build_models
from orderloom.session import packed, scratch_path
from orderloom.sources import published

DATA = "/root/testdata/sf0.001"


def _shuffled(spark):
    """Bytes of shuffle files that lie on disk now."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = [os.path.join(at, f) for d in dirs for at, _, names in os.walk(d) for f in names if f.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def _settles(spark, limit):
    for _ in range(50):  # files are removed in the background
        if (left := _shuffled(spark)) <= limit:
            break
        time.sleep(0.1)
    return left


def test_the_fact_leaves_no_wide_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = _shuffled(spark)
        fact, _ = catalog.star(spark, DATA)
        assert _settles(spark, before + 100_000) <= before + 100_000  # samples of order columns; a move of the lines is 500 kB
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert sum("_bucket" in line for line in plan.split("\n") if "Exchange hashpartitioning" in line) == 1
        assert "Exchange hashpartitioning(product_id" not in plan and "Exchange hashpartitioning(customer" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_packed_leaves_no_shuffle(spark):
    before = _shuffled(spark)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert packed(spark.range(200_000).withColumn("x", F.rand(1)).repartition(3, "x")).count() == 200_000
    assert _settles(spark, before + 10_000) <= before + 10_000 and spark.conf.get(name) == "false"


def test_lookups_come_to_the_lines(spark):
    data = [(i, i % 7, None if i % 5 == 0 else f"p{i % 11}", f"c{i % 3}") for i in range(500)]
    lines = spark.createDataFrame(data, "i int, b int, p string, c string").repartition(4)
    products = spark.createDataFrame([(f"p{i}", i, None if i == 3 else "x") for i in range(9)], "p string, n int, t string")
    people = spark.createDataFrame([("c1", 10), ("c9", 90)], "c string, m int")
    found = {"p": asked_for(lines, "b", "p", products), "c": asked_for(lines, "b", "c", people)}
    assert found["p"].count() == 7 * 9 and found["c"].count() == 7
    got = join_in_buckets(lines, found, "b", 3).select("i", "b", "p", "c", "n", "t", "m")
    want = lines.join(products, "p", "left").join(people, "c", "left").select("i", "b", "p", "c", "n", "t", "m")
    assert rows(got) == rows(want) and got.count() == 500


def test_keys_that_a_dimension_has_twice(spark):
    """Such lines are doubled, as by a join, and numbered without gaps."""
    n = 40
    items = spark.createDataFrame(
        [
            (f"e{i:03d}", datetime(2024, 1, 1 + i % 9), date(2024, 1, 1 + i % 9), 1, "ip", "AT" if i % 2 else None, None, None, "Mobile", "Other", "iOS",
             f"o{i}", f"p{i % 4}", 1 + i, Decimal("2.5"), "c1", "EUR", Decimal("1.1"), False, f"k{i % 5}")
            for i in range(n)
        ],
        "event_id string, event_timestamp timestamp, event_date date, store_id bigint, ip_address string, country_name string, region_name string,"
        "city_name string, device_category string, browser_name string, operating_system string, order_id string, product_id string, quantity bigint,"
        "transaction_price decimal(38,9), transaction_currency_symbol string, transaction_currency_code string, transaction_rate_to_usd decimal(18,6),"
        "is_recommendation_influenced boolean, customer_natural_key string",
    )
    products = spark.createDataFrame([("p1", 1), ("p2", 2), ("p2", 3)], "product_id string, product_key bigint")
    people = spark.createDataFrame([("k0", 7, True), ("k1", 8, True), ("k1", 9, False)], "customer_natural_key string, customer_key bigint, is_current boolean")
    fact = core.fact_sales_order_line(
        items, core.dim_date(spark, "2024-01-01", "2024-01-05"), products, people,
        spark.createDataFrame([("AT", "", None, 4)], "country_name string, region_name string, city_name string, location_key bigint"),
        spark.createDataFrame([("Mobile", "Other", "iOS", 5)], "device_category string, browser_name string, operating_system string, device_key bigint"),
        spark.createDataFrame([("EUR", 6)], "currency_code string, exchange_rate_key bigint"),
    )
    got = fact.orderBy("sales_line_key").collect()
    product = {"p0": [-1], "p1": [1], "p2": [2, 3], "p3": [-1]}
    want = [
        (1 + i % 9, f"e{i:03d}", p, {0: 7, 1: 8}.get(i % 5, -1), 4 if i % 2 else -1, 20240101 + i % 9 if i % 9 < 5 else core.NO_DATE_KEY)
        for i in range(n) for p in product[f"p{i % 4}"]
    ]
    assert [r.sales_line_key for r in got] == list(range(1, len(want) + 1))
    assert [(r.order_timestamp.day, r.event_id, r.product_key, r.customer_key, r.location_key, r.date_key) for r in got] == sorted(want)
    assert {(r.device_key, r.exchange_rate_key) for r in got} == {(5, 6)}
    assert all(r.line_total_usd == r.quantity * Decimal("2.75") for r in got)


def test_a_build_leaves_no_shuffles(spark):
    source = spark.range(200_000).select((F.col("id") % 40).alias("x"), F.rand(1).alias("y"))
    models = {
        "a": Model(lambda s: s.repartition(3, "y"), ("s",), cluster=("x",), dealt=True),
        "b": Model(lambda a, newer: a.select("x", "y", F.lit(date(2024, 1, 1)).alias("order_date")), ("a",), "incremental", ("x",)),
    }
    root, before = scratch_path(spark), _shuffled(spark)
    build_models(spark, root, {"s": source}, models)
    assert _settles(spark, before + 10_000) <= before + 10_000
    a = published.read_table(spark, root, "a")
    files = a.select("x", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).orderBy("f", "i").collect()
    assert len({r.f for r in files}) == 3  # written by the tasks that hold the rows, each sorted
    assert all(p.x <= r.x for p, r in zip(files, files[1:], strict=False) if p.f == r.f)
    assert rows(a.groupBy("x").count()) == rows(source.groupBy("x").count())


def test_customers_come_to_the_orders(spark):
    """Sales are the same whether customers are broadcast or asked for by the orders."""
    n = 400
    fact = packed(
        spark.range(n).select(
            F.col("id").alias("sales_line_key"), F.when(F.col("id") % 50 != 3, F.concat(F.lit("o"), F.col("id") % 90)).alias("order_id"),
            *[F.lit(1).alias(c) for c in ("store_id", "quantity", "unit_price", "line_total", "line_total_usd", "ip_address")],
            *[F.lit("c").alias(c) for c in ("transaction_currency_symbol", "transaction_currency_code")],
            (F.lit(20240101) + F.col("id") % 3).alias("date_key"),
            F.when(F.col("id") % 31 != 0, F.col("id") % 9 - 1).alias("customer_key"),
            *[F.lit(1).alias(c) for c in ("product_key", "location_key", "device_key", "exchange_rate_key")],
        )
    )
    people = spark.createDataFrame(
        [(i, f"k{i}", None if i % 2 else f"e{i}", i != 4) for i in range(6)],
        "customer_key bigint, customer_natural_key string, email_address string, is_current boolean",
    )
    flags = ["is_placeholder_quantity", "is_high_quantity_outlier", "is_high_value_outlier", "is_suspicious_pattern", "is_outlier"]
    outliers = spark.range(9).select(F.concat(F.lit("o"), "id").alias("order_id"), *[(F.col("id") % 2 == 0).alias(f) for f in flags])
    days = core.dim_date(spark, "2024-01-01", "2024-01-02")
    want = rows(intermediate.sales_with_customer(fact, days, people, outliers))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = intermediate.sales_with_customer(fact, days, people, outliers)
        assert "hashpartitioning(customer_key" not in sales._jdf.queryExecution().executedPlan().toString()
        assert rows(sales) == want and len(want) == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
