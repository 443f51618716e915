"""Stored models: order, versions, failed builds, and what a later build leaves alone."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators.history import current_rows
from orderloom.operators.keys import with_row_index
from orderloom.plans.warehouse import HISTORY_BUCKETS, MODELS, Model, build_models, needed
from orderloom.session import scratch_path
from orderloom.sources import published


def test_inputs_come_first():
    order = needed(MODELS, None, ["raw_events", "raw_products", "raw_ip_locations", "exchange_rates", "days"])
    assert set(order) == set(MODELS)
    for name in order:
        assert all(order.index(i) < order.index(name) for i in MODELS[name].inputs if i in MODELS)
    assert needed(MODELS, ["mart_customer_summary"], ["int_sales_with_customer", "dim_device", "dim_location"]) == ["mart_customer_summary"]
    with pytest.raises(KeyError, match="raw_events"):
        needed(MODELS, ["stg_events"], [])


def test_a_failed_build_leaves_the_version_before(spark):
    root = scratch_path(spark)
    source = spark.range(3)
    models = {"a": Model(lambda s: s.withColumn("n", F.lit(1)), ("s",)), "b": Model(lambda a: a.agg(F.sum("n").alias("n")), ("a",))}
    build_models(spark, root, {"s": source}, models)
    before = published.latest_version(spark, root)

    def broken(a):
        return a.select(F.raise_error(F.lit("broken")).cast("long").alias("n"))

    with pytest.raises(Exception, match="broken"):
        build_models(spark, root, {"s": spark.range(99)}, {**models, "b": Model(broken, ("a",))})
    assert published.latest_version(spark, root) == before
    assert published.read_table(spark, root, "a").count() == 3 and published.read_table(spark, root, "b").first().n == 3
    build_models(spark, root, {"s": spark.range(5)}, models)
    assert published.read_table(spark, root, "b").first().n == 5
    assert published.read_table(spark, root, "b", before[1]).first().n == 3  # readers of the old version go on


def test_of_two_builds_the_second_fails(spark):
    root = scratch_path(spark)
    entry = published.write_part(spark.range(1), root, "t")
    published.publish(spark, root, {"t": entry}, 0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        published.publish(spark, root, {}, 0)
    assert published.latest_version(spark, root)[0] == 1
    with pytest.raises(KeyError, match="no published table"):
        published.read_table(spark, root, "other")


def test_kinds_can_be_changed(spark):
    root = scratch_path(spark)
    models = {"v": Model(lambda s: s, ("s",), "view"), "t": Model(lambda v: v, ("v",))}
    build_models(spark, root, {"s": spark.range(2)}, models)
    assert set(published.latest_version(spark, root)[1]) == {"t"}
    build_models(spark, root, {"s": spark.range(2)}, models, kinds={"v": "table"})
    assert set(published.latest_version(spark, root)[1]) == {"t", "v"}
    with pytest.raises(ValueError, match="unknown kind"):
        build_models(spark, root, {"s": spark.range(2)}, models, kinds={"v": "cube"})


def _sales(spark, days):
    return spark.createDataFrame([(date.fromisoformat(d) if d else None, n) for d, n in days], "order_date date, n int")


def _mart(sales, newer_than):
    kept = sales if newer_than is None else sales.where(F.col("order_date") > newer_than)
    return kept.groupBy("order_date").agg(F.sum("n").alias("n"))


def test_incremental_months(spark):
    root, models = scratch_path(spark), {"m": Model(_mart, ("s",), "incremental")}

    def build(days, **more):
        build_models(spark, root, {"s": _sales(spark, days)}, models, **more)
        version = published.latest_version(spark, root)[1]
        return {r.order_date and str(r.order_date): r.n for r in published.read_table(spark, root, "m", version).collect()}, version["m"]

    assert build([])[0] == {}
    first = [("2024-01-30", 1), ("2024-02-10", 2), ("2024-03-05", 3), (None, 9)]
    got, one = build(first)
    assert got == {"2024-01-30": 1, "2024-02-10": 2, "2024-03-05": 3, None: 9} and set(one) == {"2024-01", "2024-02", "2024-03", "0000-00"}
    later = [*first, ("2024-01-31", 5), ("2024-03-05", 4), ("2024-04-01", 7)]
    got, two = build(later)
    assert got == {"2024-01-30": 1, "2024-02-10": 2, "2024-03-05": 7, "2024-04-01": 7, None: 9}
    assert all(two[m] == one[m] for m in ("2024-01", "2024-02", "0000-00")) and two["2024-03"] != one["2024-03"]
    assert build(later, lookback_days=70)[0]["2024-01-31"] == 5
    got, four = build([("2024-04-01", 7)], lookback_days=40)  # reopened months without rows go
    assert got == {"2024-01-30": 1, "2024-01-31": 5, "2024-04-01": 7, None: 9} and not {"2024-02", "2024-03"} & set(four)
    assert build(later, full_refresh=True)[0] == {"2024-01-30": 1, "2024-01-31": 5, "2024-02-10": 2, "2024-03-05": 7, "2024-04-01": 7, None: 9}


HISTORY = {"dim_customer": Model(lambda s: s, ("s",), "history")}


def _seen(spark, data):
    return spark.createDataFrame(
        [(k, k, "d", e, datetime(2024, 1, d)) for k, e, d in data],
        "customer_natural_key string, user_id_db string, device_id string, email_address string, event_timestamp timestamp",
    )


def test_history_replaces_touched_buckets_only(spark):
    root = scratch_path(spark)
    people = [(f"k{i}", f"e{i}", 1 + i % 20) for i in range(300)] + [("k5", "older", 1)]

    def build(data, now):
        build_models(spark, root, {"s": _seen(spark, data)}, HISTORY, now=F.lit(datetime(2024, 6, now)))
        version = published.latest_version(spark, root)[1]
        return published.read_table(spark, root, "dim_customer", version), version["dim_customer"]

    table, one = build(people, 1)
    assert table.count() == 303 and current_rows(table).count() == 302
    again, same = build(people, 2)
    assert same == one  # nothing changed: no file is written
    table, two = build([*people, ("k7", "moved", 25), ("new", None, 26)], 3)
    assert table.count() == 305 and current_rows(table).count() == 303
    assert two["closed-0"] == one["closed-0"] and len({p for p in one if two.get(p) != one[p]}) <= 2 < HISTORY_BUCKETS
    seven = {r.email_address: (r.is_current, r.valid_to.year) for r in table.where("customer_natural_key = 'k7'").collect()}
    assert seven == {"e7": (False, 2024), "moved": (True, 9999)}
    keys = [r[0] for r in table.select("customer_key").collect()]
    assert len(set(keys)) == len(keys) and max(keys) == 303
    table, three = build([*people, ("k7", "moved", 25), ("new", None, 26), ("k7", "again", 27)], 4)
    assert {three[p] for p in three if p.startswith("closed")} > {two[p] for p in two if p.startswith("closed")}
    assert current_rows(table).where("customer_natural_key = 'k7'").first().email_address == "again"


def test_row_index_and_following_rows(spark):
    data = [(None if i % 9 == 0 else f"k{i % 40:02d}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, i int").repartition(5)
    got = with_row_index(df, ["k", "i"], following=["i"]).orderBy("_index").collect()
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert [(r.k, r.i) for r in got] == want and [r._index for r in got] == list(range(1, 2001))
    assert [r._next.i if r._next else None for r in got] == [t[1] for t in want[1:]] + [None]
    assert with_row_index(df.where("i < 0"), ["k", "i"]).count() == 0
    one = with_row_index(df.where("i = 5"), ["k", "i"], following=["k"]).first()
    assert one._index == 1 and one._next is None
    assert rows(with_row_index(spark.range(3), ["id"])) == [(0, 1), (1, 2), (2, 3)]


def test_sales_lines_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks of the order totals are bounded by rows, not by the session's shuffle partitions."""
    from orderloom import session
    from orderloom.catalog import marts as m

    monkeypatch.setattr(session, "TASK_ROWS", 200)
    lines = m.fact_lines(spark, "/root/testdata/sf0.001").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = m.sales_frame(spark, "/root/testdata/sf0.001").select("order_id", F.spark_partition_id().alias("task")).cache()
        assert sales.count() == lines and sales.select("task").distinct().count() >= lines // 200
        assert sales.distinct().groupBy("order_id").count().where("count > 1").isEmpty()
        sales.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
