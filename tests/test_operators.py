"""Operators against brute force and hand-made tables."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderloom.functions.cleaning import blank_to_null, safe_double
from orderloom.operators import checks, crawl, discovery, history as scd, lookups
from orderloom.operators.dedup import latest_per_key, top_value_per_key
from orderloom.operators.keys import add_surrogate_key
from orderloom.operators.profiling import cardinality, joined_values
from orderloom.operators.quantiles import exact_quantiles, quantile_columns
from orderloom.plans import core, incremental, intermediate, quality, staging
from orderloom.plans.incremental import existing_table, run_incremental


def test_latest_per_key_is_stable(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "q")], "k string, ingested_at int, v string")
    once = latest_per_key(df, ["k"], tie_break=["v"])
    assert rows(once) == [("a", 2, "y"), ("b", 1, "q")]
    assert rows(latest_per_key(once, ["k"], tie_break=["v"])) == rows(once)


@pytest.mark.parametrize("seed", [1, 2])
def test_surrogate_keys_match_a_global_sort(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), i) for i in range(5000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, i int").repartition(7)
    got = {r.i: r.id for r in add_surrogate_key(df, "id", ["k", "i"], 100).collect()}
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert [got[i] for _, i in want] == list(range(101, 5101))


@pytest.mark.parametrize("values", [
    [Decimal("1.50")] * 700 + [Decimal(i) / 100 for i in range(1, 400)],
    [Decimal(v) for v in (-5, -5, 0, 3, 10**9, 10**9 + 1)],
    [Decimal("7")],
])
def test_exact_quantiles(spark, values):
    from math import ceil

    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    probabilities = ["0.01", "0.25", "0.5", "0.95", "0.99", "1"]
    got = {r.probability: r.value for r in exact_quantiles(df, "v", probabilities).collect()}
    ordered = sorted(values)
    for p in probabilities:
        assert got[float(p)] == ordered[max(1, ceil(Decimal(p) * len(values))) - 1]


def test_quantiles_per_group_ignore_nulls(spark):
    data = [("a", float(i)) for i in range(1, 101)] + [("b", 5.0), ("b", None), ("c", None)]
    got = exact_quantiles(spark.createDataFrame(data, "g string, v double"), "v", ["0.5"], ["g"])
    assert rows(got) == [("a", 0.5, 50.0), ("b", 0.5, 5.0)]


def test_top_value_ties_and_nulls(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("n", None)], "k string, v string")
    assert rows(top_value_per_key(df, "k", "v", "top")) == [("k", "a"), ("n", None)]


def test_ip_lookup_against_all_pairs(spark):
    rng = random.Random(5)
    starts = sorted(rng.sample(range(2**20, 2**26), 60))
    ranges = [(a, min(b - 1, a + rng.choice([0, 50, 70000, 300000])), f"c{a}", "-", "x") for a, b in zip(starts, starts[1:] + [2**26])]
    numbers = [rng.randrange(2**20, 2**26) for _ in range(500)] + starts + [r[1] for r in ranges]
    texts = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in numbers] + ["::1", "bad", "1.2.3.999"]
    got = {r.ip: r.country for r in lookups.locate_ips(
        spark.createDataFrame([(t,) for t in texts], "ip string"),
        spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, country string, region string, city string"),
    ).collect()}
    for n, text in zip(numbers, texts):
        assert got[text] == next((r[2] for r in ranges if r[0] <= n <= r[1]), None)
    assert got["::1"] is None and got["bad"] is None and got["1.2.3.999"] is None
    assert len(got) == len(set(texts))


def test_fx_pick(spark):
    fx = spark.createDataFrame(
        [("$", "%.ca/%", 1, "CAD", Decimal("0.75")), ("$", "", 2, "USD", Decimal("1")), ("€", None, None, "EUR", Decimal("1.1"))],
        "currency_symbol string, url_pattern string, priority int, currency_code string, rate_to_usd decimal(18,6)",
    )
    lines = spark.createDataFrame(
        [("1", "p", "$", "https://s.ca/x"), ("2", "p", "$", "https://s.de/x"), ("3", "p", "€", None), ("4", "p", "?", "u")],
        "event_id string, product_id string, transaction_currency_symbol string, current_url string",
    )
    picked = lookups.fx_pick(lines, fx, ["event_id", "product_id"])
    got = {r.event_id: (r.transaction_currency_code, float(r.transaction_rate_to_usd)) for r in picked.collect()}
    assert got == {"1": ("CAD", 0.75), "2": ("USD", 1.0), "3": ("EUR", 1.1), "4": ("UNKNOWN", 1.0)}


SEEN = "customer_natural_key string, user_id_db string, device_id string, email_address string, event_timestamp timestamp"


def _seen(spark, *triples):
    data = [(k, k, "d", e, datetime(2019, 10, day)) for k, e, day in triples]
    return spark.createDataFrame(data, SEEN)


def _short(history):
    return sorted((r.customer_natural_key, str(r.email_address), r.valid_from.day, r.valid_to.year, r.is_current) for r in history.collect())


def test_history_first_load(spark):
    seen = _seen(spark, ("u", "a", 1), ("u", "b", 15), ("u", "a", 20), ("v", None, 2), ("v", "x", 3))
    got = scd.initial_history(scd.collapse_versions(seen))
    assert _short(got) == [("u", "a", 1, 2019, False), ("u", "b", 15, 9999, True), ("v", "None", 2, 2019, False), ("v", "x", 3, 9999, True)]
    assert sorted(r.customer_key for r in got.collect()) == [1, 2, 3, 4]
    assert checks.not_exactly_one_current(got).count() == 0
    assert checks.inverted_ranges(got).count() == 0


def test_history_incremental(spark):
    first = _seen(spark, ("u", "a", 1), ("u", "b", 15), ("w", "k", 1))
    hist = scd.initial_history(scd.collapse_versions(first))
    more = first.unionByName(_seen(spark, ("w", "m", 20), ("n", "p", 21), ("n", "q", 22)))
    versions = scd.collapse_versions(more)
    now = F.to_timestamp(F.lit("2020-01-01"))
    merged = scd.merge_history(hist, scd.history_delta(hist, versions, now))
    assert checks.not_exactly_one_current(merged).count() == 0
    current = {r.customer_natural_key: (r.email_address, r.customer_key) for r in merged.where("is_current").collect()}
    assert current == {"u": ("b", 2), "w": ("m", 4), "n": ("q", 5)}
    again = scd.merge_history(merged, scd.history_delta(merged, versions, now))
    assert rows(again) == rows(merged)
    loose = scd.merge_history(hist, scd.history_delta(hist, versions, now, every_version=True))
    assert checks.not_exactly_one_current(loose).count() > 0


def test_watermark_and_replaced_days(spark):
    old = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 2)], "d string, n int").withColumn("order_date", F.to_date("d"))
    new = spark.createDataFrame([("2020-01-02", 9), ("2020-01-03", 3)], "d string, n int").withColumn("order_date", F.to_date("d"))
    assert [r.n for r in incremental.newer_rows(new, old).collect()] == [3]
    assert sorted(r.n for r in incremental.newer_rows(new, old, lookback_days=1).collect()) == [3, 9]
    assert sorted(r.n for r in incremental.replace_days(old, new).collect()) == [1, 3, 9]
    assert sorted(r.n for r in incremental.newer_rows(new, old.limit(0)).collect()) == [3, 9]


def test_outliers(spark):
    lines = [("bulk", 9999, "1"), ("free", 1, "0"), ("free", 1, "0")] + [(f"o{i}", 1, "10") for i in range(300)]
    fact = spark.createDataFrame([(o, q, Decimal(p), Decimal(p) * q) for o, q, p in lines],
        "order_id string, quantity bigint, unit_price decimal(18,2), line_total_usd decimal(18,2)")
    flags = {r.order_id: r for r in quality.flag_orders(fact).collect()}
    assert flags["bulk"].is_placeholder_quantity and flags["bulk"].is_outlier
    assert flags["free"].is_suspicious_pattern and not flags["free"].is_outlier
    assert {r.order_id for r in quality.sales_outliers(fact).collect()} == {"bulk"}


def test_empty_cart_vanishes_and_repeated_product_collapses(spark):
    item = "array<struct<product_id:bigint,amount:bigint,price:string,currency:string>>"
    base = "event_id string, event_timestamp timestamp, event_date date, store_id bigint, user_id_db string, device_id string, " \
        "ip_address string, device_category string, browser_name string, operating_system string, order_id string, current_url string, " \
        f"is_recommendation_influenced boolean, user_agent string, cart_products {item}"  # fmt: skip
    row = ["e", None, None, 1, None, "d", "1.1.1.1", "Mobile", "Chrome", "Android", "o", "u", False, "ua"]
    df = spark.createDataFrame(
        [(*row, []), ("f", *row[1:], [(1, 2, "1.234,50", "$"), (1, 1, "5", "$"), (2, 1, "x", None)])], base
    )
    exploded = intermediate.explode_cart(df)
    assert exploded.count() == 3
    fx = spark.createDataFrame([], "currency_symbol string, url_pattern string, priority int, currency_code string, rate_to_usd decimal(18,6)")
    places = spark.createDataFrame([("1.1.1.1", "DE", None, None)], "ip_address string, country_name string, region_name string, city_name string")
    items = intermediate.cart_items(df, places, fx)
    got = {(r.product_id, str(r.transaction_price), r.country_name, r.customer_natural_key) for r in items.collect()}
    assert got == {("1", "1234.500000000", "DE", "d"), ("2", "None", "DE", "d")}


def test_strict_store_id(spark):
    from orderloom.sources import jsonl

    lines = spark.createDataFrame([('{"_id":"a","collection":"c","store_id":"abc","time_stamp":1}',)], "line string")
    raw = jsonl.load_events(lines)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_events(raw).collect()
    assert staging.stg_events(raw, store_range=(1, 86)).count() == 0


def test_dim_date_default_range(spark):
    assert core.dim_date(spark).count() == 5844


def test_members(spark):
    products = spark.createDataFrame([], "product_id string, url string, product_name string, sku string, product_type string, "
        "collection_name string, gender string, category_id string, category_name string, currency_code string, price decimal(38,9), "
        "min_price decimal(38,9), max_price decimal(38,9), gold_weight decimal(38,9), status string, ingested_at timestamp")  # fmt: skip
    got = {r.product_key: (r.product_id, float(r.price)) for r in core.dim_product(products).collect()}
    assert got == {-1: ("UNKNOWN", 0.0), -2: ("N/A", 0.0)}


def test_crawl_summary_and_merge(spark):
    schema = "product_id string, url string, status string, http_status bigint, error_message string, fallback_used boolean"
    first = spark.createDataFrame([
        ("1", "u", "success", 200, None, False), ("2", "u", "success", 200, None, False),
        ("3", "u", "error", 403, "m", True), ("4", "u", "no_react_data", 200, "n", False),
    ], schema)
    s = crawl.summarize(first).first()
    assert (s.total, s.success, s.success_rate, s.errors, s.no_react_data, s.http_403, s.fallback_used) == (4, 2, 50.0, 1, 1, 1, 1)
    empty = crawl.summarize(first.limit(0)).first()
    assert (empty.total, empty.success_rate) == (0, 0.0)
    retry = spark.createDataFrame([("3", "u", "error", 404, "again", False), ("4", "u", "success", 200, None, False)], schema)
    blocked = spark.createDataFrame([("3", "u", "success", 200, None, False), ("4", "u", "error", 403, "no", False)], schema)
    merged = {r.product_id: (r.status, r.http_status) for r in crawl.merge_retries(first, retry, blocked).collect()}
    assert merged == {"1": ("success", 200), "2": ("success", 200), "3": ("success", 200), "4": ("success", 200)}
    assert {r.product_id: r.http_status for r in crawl.merge_retries(first, retry).collect()}["3"] == 404


def test_discovery(spark):
    docs = spark.createDataFrame([('{"a":1,"b":{"c":"x"},"d":[{"e":true},{"e":null},3]}',), ('{"a":1.5,"b":null}',), ("junk",)], "line string")
    found = {r.path: (r.kinds, r.recommended_type) for r in discovery.recommended_types(discovery.field_kinds(discovery.document_fields(docs))).collect()}
    assert found == {
        "a": ("float,int", "FLOAT64"), "b": ("object", "RECORD/STRUCT"), "b.c": ("string", "STRING"),
        "d": ("array", "ARRAY/REPEATED"), "d[].e": ("bool", "BOOL"), "d[]": ("int", "INT64"),
    }


def test_discovery_looks_at_everything(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":1}}}}},"mix":[1,2,3,"x",{"late":true}],"s":"{[\\"{{{"}'
    docs = spark.createDataFrame([(deep,), ('{"a":1,"a":"last"}',), (None,), ("",)], "line string")
    found = {r.path: r.kinds for r in discovery.recommended_types(discovery.field_kinds(discovery.document_fields(docs))).collect()}
    assert found["a.b.c.d.e.f"] == "int" and found["mix[]"] == "int,string" and found["mix[].late"] == "bool"
    assert found["a"] == "object,string" and found["s"] == "string"
    assert discovery.document_fields(docs.limit(0)).count() == 0


def test_fx_pick_keeps_lines_without_symbol_and_matches_patterns(spark):
    rates = spark.createDataFrame(
        [("$", "%.ca/%", 1, "CAD", 0.7), ("$", None, 5, "USD", 1.0), ("$", "", None, "XXX", 9.0), ("kr", "%.se/%", 1, "SEK", 0.1), (None, None, 1, "NUL", 5.0)],
        "currency_symbol string, url_pattern string, priority int, currency_code string, rate_to_usd double",
    )
    items = spark.createDataFrame(
        [(1, "$", "http://a.ca/x"), (2, "$", "http://a.us/x"), (3, "kr", "http://a.no/x"), (4, None, "u"), (5, "$", None)],
        "k int, transaction_currency_symbol string, current_url string",
    )
    got = {r.k: (r.transaction_currency_code, r.transaction_rate_to_usd) for r in lookups.fx_pick(items, rates, ["k"]).collect()}
    assert got == {1: ("CAD", 0.7), 2: ("USD", 1.0), 3: ("UNKNOWN", 1.0), 4: ("UNKNOWN", 1.0), 5: ("USD", 1.0)}
    plan = lookups.fx_pick(items, rates, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_nan_and_words_are_no_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    got = {r.probability: r.value for r in exact_quantiles(df, "x", ["0.1", "0.5", "0.7", "1"]).collect()}
    assert got[0.1] == float("-inf") and got[0.5] == 3.0 and got[0.7] == float("inf") and got[1.0] != got[1.0]
    texts = [("1.5",), (" -2e3 ",), (".5",), ("NaN",), ("Infinity",), ("1.5d",), ("0x1",), ("",), (None,)]
    got = [r.v for r in spark.createDataFrame(texts, "t string").select(safe_double("t").alias("v")).collect()]
    assert got == [1.5, -2000.0, 0.5, None, None, None, None, None, None]


def test_joined_values_with_several_keys(spark):
    many = spark.createDataFrame([("k", n % 2, f"v{n:03d}") for n in range(18)] * 2, "k string, p int, v string")
    got = {r.p: r.vs for r in joined_values(many, ["k", "p"], "v", "vs", 3).collect()}
    assert got == {0: "v000, v002, v004", 1: "v001, v003, v005"}


def test_full_refresh_drops_old_days_in_a_dynamic_session(spark, tmp_path):
    path = str(tmp_path / "t")
    days = lambda *d: spark.createDataFrame([(x, 1) for x in d], "order_date string, n int").withColumn("order_date", F.to_date("order_date"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run_incremental(spark, path, lambda mark: days("2024-01-01", "2024-01-02", "2024-01-03"))
        run_incremental(spark, path, lambda mark: days("2024-01-02"), full_refresh=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [str(r.order_date) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]


def test_a_broken_table_is_not_taken_for_a_missing_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    with pytest.raises(AnalysisException):
        existing_table(spark, str(tmp_path / "t"))
    assert existing_table(spark, str(tmp_path / "none")) is None


def test_cardinality_and_joined_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2), ("b", None)], "x string, y int")
    assert tuple(cardinality(df, ["x", "y"]).first()) == (2, 2)
    many = spark.createDataFrame([("k", f"v{i:03d}") for i in range(50)] * 2, "k string, v string")
    assert joined_values(many, ["k"], "v", "vs", 3).first().vs == "v000, v001, v002"


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    parent = spark.createDataFrame([("a",)], "y string")
    got = checks.run_checks({
        "unique": checks.duplicated_values(df, "x"), "null": checks.null_rows(df, "x"),
        "values": checks.unexpected_values(df, "x", ["a", "b"]), "fk": checks.orphans(df, "x", parent, "y"),
        "fk ok": checks.orphans(df, "x", parent, "y", ["b"]),
    })
    assert rows(got) == [("fk", 1, False), ("fk ok", 0, True), ("null", 1, False), ("unique", 1, False), ("values", 0, True)]


def test_null_as_empty_is_an_equi_join(spark):
    a = spark.createDataFrame([("x", None), ("y", "")], "k string, v string")
    b = spark.createDataFrame([("", 1)], "w string, n int")
    assert a.join(b, lookups.null_as_empty(F.col("v"), F.col("w"))).count() == 2
    assert a.where(blank_to_null("v").isNull()).count() == 2


def test_quantiles_see_the_same_brackets_in_every_step(spark):
    """Without reuse of shuffles each step reads its input again; a sketch is not the same twice."""
    df = spark.range(400_000).select((F.col("id") % 4).alias("g"), (F.hash("id") % 100_000).cast("double").alias("v"))
    want = df.groupBy("g").agg(F.expr("percentile_disc(0.5) within group (order by v)").alias("m"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert rows(quantile_columns(df, "v", {"m": "0.5"}, ["g"])) == rows(want)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_documents_of_one_shape_are_opened_once(spark):
    texts = [
        '{"a":"x","b":[1,2.5,{"c":null}],"d":{"e":true}}', '{"a":"{\\"1\\":2}","b":[77,1e9,{"c":null}],"d":{"e":true}}',
        '{"a": "\\u00e9, \\\\", "b": [-3, -0.25, {"c": null}], "d": {"e": true}}',
        '{"k 12,3":1}', '{"k 12,4":1}', '{"k\\"":1.5,"":"","n":12345678901234567890}', '{"n":1234567890123456789}', '{"n":9999999999999999999}',
        '{"a":01}', '{"a":1.}', '{"a":"\\x"}', '{"a":"y"', '[1,{"a":2}]', '{"a":1,"a":"z"}', '{"a":2,"a":""}', '7', '"s"', '{"a":-}', '{"a":1e400}', '{"a":1e05}', '{"a":10.05,"b":0}', '{"a":-0.0}', '{"a":.5}',
        '{"a":"' + "long \\n" * 20000 + '","b":3}', '{"a":"\x01"}', '{"a":1 2}', '{"a":1.5.5}', '{"a":tru1}', '{}', '{"a":{"b":[[1,"x"],[2.0]]}}',
    ]
    docs = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts * 3)], "line string, side int")
    wanted = discovery.field_kinds(discovery.document_fields(docs, carry=("side",)), by=("side",)).drop("sample")
    got = discovery.field_counts(docs, carry=("side",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    many = spark.range(500).selectExpr("""'{"id":' || id || ',"x":"' || md5(CAST(id AS STRING)) || '","y":[' || id / 7.5D || ']}' AS line""")
    assert many.select(discovery.shape(F.col("line"))).distinct().count() == 1
    assert {(r.path, r.kind, r.occurrences) for r in discovery.field_counts(many).collect()} == {
        ("id", "int", 500), ("x", "string", 500), ("y", "array", 500), ("y[]", "float", 500),
    }


def test_carts_without_repeats_need_no_shuffle(spark):
    item = "array<struct<product_id:bigint,amount:bigint,price:string,currency:string>>"
    base = "event_id string, event_timestamp timestamp, event_date date, store_id bigint, user_id_db string, device_id string, " \
        "ip_address string, device_category string, browser_name string, operating_system string, order_id string, current_url string, " \
        f"is_recommendation_influenced boolean, user_agent string, cart_products {item}"  # fmt: skip
    row = [None, None, 1, None, "d", "1.1.1.1", "Mobile", "Chrome", "Android", "o", "u.ca/", False, "ua"]
    carts = {
        "none": [], "one": [(1, 2, "5", "$")], "two": [(1, 2, "5", "$"), (2, 1, "7", "e")], "again": [(1, 1, "5", "$"), (1, 1, "9", "$"), (2, 1, "3", "$")],
        "rated": [(3, 1, "5", "e"), (3, 1, "50", "$")], "nulls": [(None, 1, "5", "$"), (None, 2, "5", "$"), (4, 1, None, None)],
    }
    df = spark.createDataFrame([(e, *row, c) for e, c in carts.items()], base)
    fx = spark.createDataFrame([("$", "", 2, "USD", Decimal("1.1")), ("$", "%.ca/%", 1, "CAD", Decimal("0.7")), ("e", None, None, "EUR", Decimal("1.2"))],
        "currency_symbol string, url_pattern string, priority int, currency_code string, rate_to_usd decimal(18,6)")
    places = spark.createDataFrame([("1.1.1.1", "DE", None, None)], "ip_address string, country_name string, region_name string, city_name string")
    whole = intermediate.cart_items(df, places, fx)
    parted = intermediate.cart_items(df, places, fx, unique_events=True)
    assert parted.columns == whole.columns and parted.count() == 8
    assert sorted(map(str, parted.collect())) == sorted(map(str, whole.collect()))


def test_product_mart_counts_without_tripling_rows(spark):
    from orderloom.plans import marts

    day = datetime(2024, 5, 1).date()
    rows = [("a", "x@p.de"), ("a", "y@q.de"), ("a", "x@p.de"), ("b", "z@p.de"), ("b", None), (None, "w@r.de")]
    sales = spark.createDataFrame(
        [(day, 1, o, 2, Decimal("3"), Decimal("1.5"), e is None, e, False) for o, e in rows] + [(day, 1, "c", 9, Decimal("9"), None, False, "o@o.de", True)],
        "order_date date, product_key bigint, order_id string, quantity bigint, line_total_usd decimal(38,9), unit_price decimal(38,9), "
        "is_guest boolean, email_address string, is_outlier boolean",
    )
    names = ["product_id", "product_name", "sku", "product_type", "category_id", "category_name", "collection_name", "gender", "currency_code"]
    products = spark.range(1).select(F.lit(1).cast("bigint").alias("product_key"), *[F.lit(n).alias(n) for n in names],
        *[F.lit("1").alias(n) for n in ("price", "min_price", "max_price", "gold_weight")])
    mart = marts.mart_sales_by_product(sales, products, core.dim_date(spark))
    r = mart.first()
    assert (r.order_count, r.line_item_count, r.units_sold, r.revenue_usd, r.avg_unit_price) == (2, 6, 12, 18, Decimal("1.5"))
    assert (r.registered_customer_orders, r.guest_orders, r.unique_email_domains) == (5, 1, len({e.split("@")[1] for _, e in rows if e}))
    assert "Expand" not in mart._jdf.queryExecution().optimizedPlan().toString()


def test_events_are_dressed_up_from_stored_lines(spark):
    from orderloom.catalog.frames import distinct_checkouts, staged_checkouts

    sf = "/root/testdata/sf0.001"
    got, want = distinct_checkouts(spark, sf), latest_per_key(staged_checkouts(spark, sf), ["event_id"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "user_agent" not in plan.split("Relation")[-1]


def test_cart_items_model_trusts_staged_events():
    from orderloom.plans.warehouse import MODELS

    assert MODELS["int_events_cart_items"].build.keywords == {"unique_events": True}


def test_daily_marts_count_orders_and_customers_without_multiplying_rows(spark):
    from orderloom.plans import marts

    day = datetime(2024, 5, 1).date()
    # order, customer, guest: an order of two customers, one of two lines of the same, no customer, no order, no person
    lines = [("a", 1, False), ("a", 2, True), ("b", 1, False), ("b", 1, False), ("c", None, None), (None, 3, True)]
    sales = spark.createDataFrame(
        [(day, 7, 1, 1, o, c, 2, Decimal("1.5"), g, False) for o, c, g in lines] + [(day, 7, 1, 1, "x", 9, 9, Decimal("9"), True, True)],
        "order_date date, store_id bigint, device_key bigint, location_key bigint, order_id string, customer_key bigint, quantity bigint, "
        "line_total_usd decimal(38,9), is_guest boolean, is_outlier boolean",
    )
    devices = spark.createDataFrame([(1, "Mobile", True)], "device_key bigint, device_category string, is_mobile boolean")
    places = spark.createDataFrame([(1, "DE", "BE", "Berlin")], "location_key bigint, country_name string, region_name string, city_name string")
    daily = marts.mart_sales_daily(sales, devices, core.dim_date(spark))
    place = marts.mart_sales_by_geography(sales, places, core.dim_date(spark))
    for mart in (daily, place):
        r = mart.first()
        assert (mart.count(), r.order_count, r.line_item_count, r.units_sold, r.revenue_usd, r.unique_customers) == (1, 3, 6, 12, 9, 3)
        assert "Expand" not in mart._jdf.queryExecution().optimizedPlan().toString()
    assert (daily.first().guest_orders, daily.first().registered_orders) == (2, 3)


def test_sales_lines_are_not_sorted_for_their_flags(spark):
    day = datetime(2024, 5, 1)
    names = ["sales_line_key", "order_id", "store_id", "quantity", "unit_price", "line_total", "line_total_usd", "transaction_currency_symbol",
             "transaction_currency_code", "ip_address", "date_key", "customer_key", "product_key", "location_key", "device_key", "exchange_rate_key"]
    fact = spark.range(40).select(*[F.lit(20240501 if n == "date_key" else 1).cast("bigint").alias(n) for n in names if n != "order_id"],
        (F.col("id") % 10).cast("string").alias("order_id"))
    days = spark.createDataFrame([(20240501, day.date())], "date_key bigint, full_date date")
    people = spark.createDataFrame([(1, "k", "a@b.de", True)], "customer_key bigint, customer_natural_key string, email_address string, is_current boolean")
    flags = ["is_placeholder_quantity", "is_high_quantity_outlier", "is_high_value_outlier", "is_suspicious_pattern", "is_outlier"]
    outliers = spark.createDataFrame([("3", True, False, True, False, True), ("none", *[True] * 5)], ", ".join(["order_id string", *[f"{f} boolean" for f in flags]]))
    sales = intermediate.sales_with_customer(fact, days, people, outliers)
    got = [(r.order_id, *[r[f] for f in flags]) for r in sales.collect()]
    assert sorted(got) == sorted([("3", True, False, True, False, True)] * 4 + [(str(i), *[False] * 5) for i in range(10) if i != 3] * 4)
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [order_id" in plan and "Sort [order_id" not in plan
