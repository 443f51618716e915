"""Reading, typing, routing and exporting raw files."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.frames import raw_events, raw_ip_locations, raw_products
from orderloom.catalog.registry import query, scratch
from orderloom.catalog.standins import duck, table, view
from orderloom.functions import documents
from orderloom.operators import sampling
from orderloom.session import stored
from orderloom.sources import exports, jsonl, routing, schemas

TYPES = ("checkout", "checkout_success", "add_to_cart_action")
def _load_time():
    return F.to_timestamp(F.lit("2024-02-03 00:00:00"))


def _lines(spark, sf):
    """The events as gzipped JSON-lines files, read back as text."""
    path = scratch(spark) + "/raw/events"
    lines = view(spark, sf, "jsonl").select("line").repartition(spark.sparkContext.defaultParallelism)
    lines.write.option("compression", "gzip").text(path)
    return jsonl.read_lines(spark, path)


def _loaded(spark, sf, **options):
    """The raw events table: loaded from files and stored."""
    return stored(jsonl.load_events(_lines(spark, sf), loaded_at=_load_time(), **options))


@query(
    "scan_jsonl_lines",
    duck(
        """SELECT sha, CAST(count(*) AS BIGINT) AS n FROM (SELECT md5(line) AS sha FROM jsonl WHERE trim(line) <> '')
        GROUP BY sha""",
        "jsonl",
    ),
)
def scan_jsonl_lines(spark, sf):
    """Write gzipped lines, read them back by glob, drop blank ones."""
    lines = jsonl.not_blank(_lines(spark, sf))
    return lines.groupBy(F.md5("line").alias("sha")).agg(F.count("*").alias("n"))


@query(
    "load_events_typed",
    duck(
        """SELECT _id, device_id, user_id_db, email_address, ip, store_id, user_agent, resolution,
          CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'google' END AS utm_source, CAST(NULL AS VARCHAR) AS utm_medium,
          collection, time_stamp, current_url, product_id, price, currency,
          CASE WHEN event_id % 6 = 1 THEN '[gold' WHEN event_id % 6 <> 0 THEN 'ring' END AS key_search,
          CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS options,
          CASE event_id % 5 WHEN 0 THEN 'alloy=gold-' || store_id || ';diamond=' WHEN 1 THEN 'alloy=red;stone=' ELSE '' END AS option_text,
          CAST(CASE WHEN collection = 'checkout_success' THEN 2 ELSE 0 END AS BIGINT) AS cart_lines,
          CASE WHEN collection = 'checkout_success' THEN CAST(event_id % 4 + 2 AS BIGINT) END AS cart_units,
          CASE WHEN collection = 'checkout_success' THEN CAST(261151 AS BIGINT) END AS cart_option_id,
          order_id, CASE WHEN event_id % 4 = 0 THEN TRUE WHEN event_id % 4 = 1 THEN FALSE END AS is_paypal, recommendation,
          CASE WHEN event_id % 8 = 0 THEN event_id % 12 END AS recommendation_clicked_position,
          '2024-02-03 00:00:00' AS ingested_at
        FROM ev""",
        "ev",
    ),
)
def load_events_typed(spark, sf):
    """Typed events from JSON lines; nested arrays shown by size and text."""
    df = jsonl.load_events(_lines(spark, sf), loaded_at=_load_time())
    pairs = F.transform("option", lambda o: F.concat(o["option_label"], F.lit("="), F.coalesce(o["value_label"], F.lit(""))))
    units = F.aggregate("cart_products", F.lit(0).cast("bigint"), lambda acc, c: acc + c["amount"])
    return df.select(
        "_id", "device_id", "user_id_db", "email_address", "ip", "store_id", "user_agent", "resolution", "utm_source",
        "utm_medium", "collection", "time_stamp", "current_url", "product_id", "price", "currency", "key_search",
        F.size("option").alias("options"), F.array_join(pairs, ";").alias("option_text"),
        F.size("cart_products").alias("cart_lines"),
        F.when(F.size("cart_products") > 0, units).alias("cart_units"),
        F.get(F.get("cart_products", F.lit(1))["option"], F.lit(0))["option_id"].alias("cart_option_id"),
        "order_id", "is_paypal", "recommendation", "recommendation_clicked_position", "ingested_at",
    )


@query(
    "load_products_typed",
    duck(
        """SELECT product_id, url, status, CAST(http_status AS BIGINT) AS http_status, error_message, fallback_used, product_name,
          sku, price, category_name, CAST(p_partkey % 4 AS BIGINT) AS visible, CAST(p_partkey % 7 AS DOUBLE) / 4 AS tax_rate,
          gold_weight, p_partkey % 90 AS qty FROM prod""",
        "prod",
    ),
)
def load_products_typed(spark, sf):
    """Typed catalogue rows from JSON lines, with a repeated text field."""
    p = view(spark, sf, "prod")
    part = F.col("p_partkey")
    doc = p.withColumns(
        {
            "visible_contents": F.transform(F.slice(F.array(*[F.lit(x) for x in "abc"]), F.lit(1), (part % 4).cast("int")), lambda x: x),
            "tax_rate": (part % 7) / 4,
            "qty": F.when(part % 2 == 0, (part % 90).cast("string")).otherwise((part % 90).cast("string")),
        }
    )
    lines = doc.select(F.to_json(F.struct(*[c for c in doc.columns if c not in ("ingest_date", "p_partkey")])).alias("line"))
    df = jsonl.load_products(lines, loaded_at=_load_time())
    return df.select(
        "product_id", "url", "status", "http_status", "error_message", "fallback_used", "product_name", "sku", "price",
        "category_name", F.size("visible_contents").alias("visible"), "tax_rate", "gold_weight", "qty",
    )


@query(
    "load_ip_locations_typed",
    duck("SELECT ip, country, region, city, '2024-02-03 00:00:00' AS ingested_at FROM geo", "geo"),
)
def load_ip_locations_typed(spark, sf):
    rows = raw_ip_locations(spark, sf).select("ip", "country", "region", "city")
    return jsonl.load_ip_locations(rows.select(F.to_json(F.struct("*")).alias("line")), loaded_at=_load_time())


@query(
    "scan_by_date_glob",
    duck(
        "SELECT user_id % 3 AS part, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ev WHERE event_id % 2 = 0 GROUP BY 1",
        "ev",
    ),
)
def scan_by_date_glob(spark, sf):
    """Files of one date are picked by glob; the other date's files are not opened."""
    root = scratch(spark)
    ev = view(spark, sf, "ev").select("event_id", (F.col("user_id") % 3).alias("part"))
    for date, keep in (("20240201", 0), ("20240202", 1)):
        day = ev.where(F.col("event_id") % 2 == keep)
        folder = f"{root}/raw/events/events_{date}_part1.jsonl.gz"
        day.write.option("compression", "gzip").json(folder)
    chosen = spark.read.schema("event_id bigint, part bigint").json(routing.raw_glob(root, "events", "20240201"))
    return chosen.groupBy("part").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


PATHS = """SELECT CASE event_id % 5 WHEN 0 THEN 'raw/events/events_20240201_part' WHEN 1 THEN 'raw/ip_locations/ip_locations_'
  WHEN 2 THEN 'raw/products/products_' WHEN 3 THEN 'raw/shop/products_' ELSE 'other/raw/events/' END
  || CAST(event_id AS STRING) || '.jsonl.gz' AS path FROM ev"""


@query(
    "route_by_path",
    duck(
        """SELECT CASE WHEN starts_with(path, 'raw/events/') THEN 'events' WHEN starts_with(path, 'raw/ip_locations/') THEN 'ip_locations'
          WHEN starts_with(path, 'raw/products/') THEN 'products' END AS table_name, CAST(count(*) AS BIGINT) AS files
        FROM paths GROUP BY 1""",
        "ev",
        paths=PATHS,
    ),
)
def route_by_path(spark, sf):
    view(spark, sf, "ev").createOrReplaceTempView("ev")
    routed = spark.sql(PATHS).select(routing.table_of_path("path").alias("table_name"))
    return routed.groupBy("table_name").agg(F.count("*").alias("files"))


@query(
    "validate_load",
    duck(
        """SELECT CAST(count(*) AS BIGINT) AS total_rows, strftime(CAST(min(ingest_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS earliest_ingestion,
          strftime(CAST(max(ingest_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS latest_ingestion,
          CAST(count(DISTINCT ingest_date) AS BIGINT) AS distinct_ingestion_dates, count(*) > 0 AS has_rows FROM ev_dup""",
        "ev_dup",
    ),
)
def validate_load(spark, sf):
    return routing.validate_load(raw_events(spark, sf, "ev_dup"))


@query(
    "export_events_parts",
    duck("SELECT CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS parts_above_limit FROM ev", "ev"),
)
def export_events_parts(spark, sf):
    """Gzipped JSON parts of limited size: rows written, and parts above the limit."""
    path = scratch(spark) + "/export"
    exports.export_parts(view(spark, sf, "ev"), path, rows_per_part=2000)
    rows = spark.read.text(path).groupBy("_metadata.file_name").agg(F.count("*").alias("n"))
    return rows.agg(F.sum("n").alias("records"), F.count_if(F.col("n") > 2000).alias("parts_above_limit"))


@query(
    "append_raw_table",
    duck("SELECT collection, CAST(2 * count(*) AS BIGINT) AS records FROM ev GROUP BY 1", "ev"),
)
def append_raw_table(spark, sf):
    """Two deliveries of the same file appended to one raw table: duplicates stay until staging drops them."""
    path = scratch(spark) + "/raw_events"
    lines = stored(view(spark, sf, "jsonl").select("line"))
    for _ in range(2):
        jsonl.append_rows(jsonl.load_events(lines, loaded_at=_load_time()), path)
    return spark.read.parquet(path).groupBy("collection").agg(F.count("*").alias("records"))


@query(
    "check_sources",
    duck(
        """SELECT 'events' AS table_name, c AS column_name, CAST(0 AS BIGINT) AS missing FROM (VALUES ('_id'), ('collection'), ('ingested_at')) t(c)
        UNION ALL SELECT 'ip_locations', c, CAST(0 AS BIGINT) FROM (VALUES ('ip'), ('ingested_at')) t(c)
        UNION ALL SELECT 'products', 'product_id', CAST(count(*) FILTER (product_id IS NULL) AS BIGINT) FROM prod
        UNION ALL SELECT 'products', 'ingested_at', CAST(0 AS BIGINT)""",
        "prod",
    ),
)
def check_sources(spark, sf):
    """Missing values in the columns that the raw tables must have."""
    raw = {"events": raw_events(spark, sf), "ip_locations": raw_ip_locations(spark, sf), "products": raw_products(spark, sf)}
    out = None
    for name, df in raw.items():
        one = schemas.missing_required(df, name)
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "quarantine_lines",
    duck(
        """SELECT 'kept' AS outcome, CAST(count(*) AS BIGINT) AS records FROM jsonl WHERE trim(line) <> '' AND event_id % 9 <> 4
        UNION ALL SELECT 'rejected', CAST(count(*) AS BIGINT) FROM jsonl WHERE trim(line) <> '' AND event_id % 9 = 4""",
        "jsonl",
    ),
)
def quarantine_lines(spark, sf):
    """Cut-off and non-object lines are set aside, the others load strictly."""
    lines = view(spark, sf, "jsonl")
    broken = F.when(F.col("event_id") % 2 == 0, F.expr("left(line, length(line) - 3)")).otherwise(F.concat(F.lit("["), "line", F.lit("]")))
    spoiled = (F.trim("line") != "") & (F.col("event_id") % 9 == 4)
    lines = stored(lines.select(F.when(spoiled, broken).otherwise(F.col("line")).alias("line")))
    good, bad = jsonl.split_rejected(lines)
    loaded = jsonl.load_events(good, loaded_at=_load_time())
    kept = loaded.agg(F.count("_id").alias("records")).select(F.lit("kept").alias("outcome"), "records")
    return kept.unionByName(bad.agg(F.count("*").alias("records")).select(F.lit("rejected").alias("outcome"), "records"))


@query(
    "export_filter_types",
    duck(
        """SELECT collection, CAST(count(*) AS BIGINT) AS records FROM ev
        WHERE collection IN ('checkout', 'checkout_success', 'add_to_cart_action') GROUP BY 1""",
        "ev",
    ),
)
def export_filter_types(spark, sf):
    chosen = exports.of_types(view(spark, sf, "ev"), "collection", TYPES)
    return chosen.groupBy("collection").agg(F.count("*").alias("records"))


@query(
    "export_resume_after_id",
    duck(
        """SELECT collection, CAST(count(*) AS BIGINT) AS records, min(_id) AS first_id FROM ev
        WHERE _id > 'e000000000400' GROUP BY 1""",
        "ev",
    ),
)
def export_resume_after_id(spark, sf):
    rest = exports.after_key(view(spark, sf, "ev"), "_id", "e000000000400")
    return rest.groupBy("collection").agg(F.count("*").alias("records"), F.min("_id").alias("first_id"))


@query(
    "export_stats",
    """SELECT CAST(count(*) AS BIGINT) AS records,
      CAST(sum(strlen('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}') + 1) AS BIGINT)
        AS uncompressed_bytes FROM documents""",
)
def export_stats(spark, sf):
    return exports.export_stats(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"))


@query(
    "json_array_to_jsonl",
    duck("SELECT product_id, status, CAST(http_status AS BIGINT) AS http_status FROM prod WHERE status = 'success'", "prod"),
)
def json_array_to_jsonl(spark, sf):
    """JSON array files become JSON lines, filtered by status."""
    root = scratch(spark)
    rows = raw_products(spark, sf).select("product_id", "status", "http_status")
    chunk = F.floor(F.monotonically_increasing_id() / 500)  # at most 500 rows per array
    arrays = rows.groupBy(chunk.alias("file")).agg(
        F.to_json(F.collect_list(F.struct("product_id", "status", "http_status"))).alias("doc")
    )
    # One array per file: the text writer puts every record into its own file.
    arrays.select("doc").write.option("maxRecordsPerFile", 1).text(f"{root}/arrays")
    schema = "product_id string, status string, http_status bigint"
    kept = jsonl.json_array_to_lines(spark, f"{root}/arrays", schema, jsonl.field_equals("status", "success"))
    kept.write.option("compression", "gzip").json(f"{root}/jsonl")
    return spark.read.schema(schema).json(f"{root}/jsonl")


@query(
    "csv_round_trip",
    duck("SELECT product_id, url FROM prod WHERE status = 'success' AND url <> ''", "prod"),
)
def csv_round_trip(spark, sf):
    """CSV with header, written and read back with a declared schema."""
    path = scratch(spark) + "/csv"
    urls = view(spark, sf, "prod").where((F.col("status") == "success") & (F.col("url") != "")).select("product_id", "url")
    exports.write_csv(urls, path)
    return exports.read_csv(spark, path, "product_id string, url string")


@query("distinct_sorted_ips", duck("SELECT DISTINCT ip FROM ev WHERE ip <> ''", "ev"))
def distinct_sorted_ips(spark, sf):
    """Sorted distinct addresses through a text file."""
    path = scratch(spark) + "/ips"
    exports.write_text_list(exports.distinct_sorted(view(spark, sf, "ev"), "ip"), "ip", path)
    return spark.read.text(path).select(F.col("value").alias("ip"))


@query(
    "partitioned_write_read",
    duck(
        """SELECT order_date, CAST(count(*) AS BIGINT) AS n, CAST(sum(usd_cents) AS BIGINT) AS cents FROM sales
        WHERE order_date >= DATE '1998-01-01' GROUP BY 1""",
        "sales",
    ),
)
def partitioned_write_read(spark, sf):
    """Day-partitioned table, read back with partition pruning."""
    path = scratch(spark) + "/table"
    sales = view(spark, sf, "sales").select("order_date", "store_id", "product_key", "usd_cents")
    by_month = sales.withColumn("month", F.date_format("order_date", "yyyyMM"))
    exports.write_partitioned(by_month, path, "month", ["store_id", "product_key"])
    late = spark.read.parquet(path).where((F.col("month") >= "199801") & (F.col("order_date") >= F.lit("1998-01-01").cast("date")))
    return late.groupBy("order_date").agg(F.count("*").alias("n"), F.sum("usd_cents").alias("cents"))


@query(
    "export_test_sample",
    duck(
        """SELECT _id, collection, store_id FROM ev WHERE collection IN ('checkout', 'checkout_success', 'add_to_cart_action')
        ORDER BY _id LIMIT 1000""",
        "ev",
    ),
)
def export_test_sample(spark, sf):
    return exports.sample_of_types(view(spark, sf, "ev"), "collection", TYPES, "_id", 1000).select("_id", "collection", "store_id")


@query("sample_one_per_type", duck("SELECT collection, min(_id) AS _id FROM ev GROUP BY 1", "ev"))
def sample_one_per_type(spark, sf):
    return exports.first_per_type(view(spark, sf, "ev"), "collection", ["_id"]).select("collection", "_id")


@query(
    "stratified_sample",
    duck(
        "SELECT collection, _id FROM ev QUALIFY row_number() OVER (PARTITION BY collection ORDER BY _id) <= 10",
        "ev",
    ),
)
def stratified_sample(spark, sf):
    return sampling.stratified(view(spark, sf, "ev"), "collection", 10, ["_id"]).select("collection", "_id")


@query(
    "sample_records",
    duck(
        """(SELECT 'random' AS sample, ip, country, region, city FROM geo ORDER BY md5(ip || '|' || CAST(c_custkey AS VARCHAR)), ip, c_custkey LIMIT 20)
        UNION ALL (SELECT 'complete', ip, country, region, city FROM geo
          WHERE country <> '' AND region <> '' AND city <> '' ORDER BY ip, c_custkey LIMIT 10)
        UNION ALL (SELECT 'empty', ip, country, region, city FROM geo
          WHERE coalesce(country, '') = '' AND coalesce(region, '') = '' AND coalesce(city, '') = '' ORDER BY ip, c_custkey LIMIT 10)""",
        "geo",
    ),
)
def sample_records(spark, sf):
    """Repeatable random rows, complete rows and empty rows."""
    from orderloom.operators.profiling import full_place, no_place

    geo = view(spark, sf, "geo")
    parts = {
        "random": sampling.repeatable_rows(geo, 20, ["ip", "c_custkey"]),
        "complete": sampling.matching_rows(geo, full_place(), 10, ["ip", "c_custkey"]),
        "empty": sampling.matching_rows(geo, no_place(), 10, ["ip", "c_custkey"]),
    }
    out = None
    for name, rows in parts.items():
        named = rows.select(F.lit(name).alias("sample"), "ip", "country", "region", "city")
        out = named if out is None else out.unionByName(named)
    return out


@query(
    "timestamp_range",
    duck("SELECT min(time_stamp) AS first_second, max(time_stamp) AS last_second FROM ev", "ev"),
)
def timestamp_range(spark, sf):
    return view(spark, sf, "ev").agg(F.min("time_stamp").alias("first_second"), F.max("time_stamp").alias("last_second"))


@query(
    "json_value_extract",
    duck(
        """SELECT _id, store_id, CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'google' END AS utm_source,
          CASE WHEN event_id % 6 = 1 THEN '[gold' WHEN event_id % 6 <> 0 THEN 'ring' END AS key_search,
          CASE WHEN collection = 'checkout_success' THEN CAST(event_id % 500 AS VARCHAR) END AS first_product
        FROM ev""",
        "ev",
    ),
)
def json_value_extract(spark, sf):
    """Scalars by JSON path; objects and arrays give NULL."""
    lines = jsonl.not_blank(_lines(spark, sf))
    paths = {
        "_id": "$._id", "store_id": "$.store_id", "utm_source": "$.utm_source", "key_search": "$.key_search",
        "first_product": "$.cart_products[0].product_id",
    }
    return lines.select(*[documents.json_scalar("line", path).alias(name) for name, path in paths.items()])


OPTION_ORACLE = """SELECT _id, CAST(pos AS BIGINT) AS pos, option_id, option_label, value_id, value_label, quality FROM (
  SELECT _id, 0 AS pos, NULL AS option_id, 'alloy' AS option_label, NULL AS value_id, 'gold-' || store_id AS value_label, NULL AS quality
    FROM ev WHERE event_id % 5 = 0
  UNION ALL SELECT _id, 1, NULL, 'diamond', NULL, NULL, NULL FROM ev WHERE event_id % 5 = 0
  UNION ALL SELECT _id, 0, CAST(event_id % 100 AS VARCHAR), 'alloy', '7', 'red', NULL FROM ev WHERE event_id % 5 = 1
  UNION ALL SELECT _id, 1, NULL, 'stone', NULL, NULL, 'A' FROM ev WHERE event_id % 5 = 1)"""


@query("normalize_option", duck(OPTION_ORACLE, "ev"))
def normalize_option(spark, sf):
    """Options of every shape as rows."""
    df = _loaded(spark, sf)
    rows = df.select("_id", F.posexplode("option").alias("pos", "o"))
    return rows.select("_id", "pos", *[F.col(f"o.{n}").alias(n) for n in ("option_id", "option_label", "value_id", "value_label", "quality")])


@query(
    "normalize_event",
    duck(
        """SELECT _id, CAST(event_id % 500 AS BIGINT) AS product_id, CAST(0 AS BIGINT) AS options FROM ev WHERE collection = 'checkout_success'
        UNION ALL SELECT _id, CAST(event_id % 300 AS BIGINT), CAST(1 AS BIGINT) FROM ev WHERE collection = 'checkout_success'""",
        "ev",
    ),
)
def normalize_event(spark, sf):
    """Cart lines with their own options normalised."""
    df = _loaded(spark, sf)
    rows = df.select("_id", F.explode("cart_products").alias("c"))
    return rows.select("_id", F.col("c.product_id").alias("product_id"), F.size("c.option").alias("options"))


@query(
    "nested_cart_rebuild",
    duck(
        """SELECT _id, CAST(event_id % 300 AS BIGINT) AS product_id, CAST(1 AS BIGINT) AS amount, '9.90' AS price,
          CAST(261151 AS BIGINT) AS option_id, 'diamond' AS option_label, CAST(2166253 AS BIGINT) AS value_id, 'Sapphire' AS value_label
        FROM ev WHERE collection = 'checkout_success'""",
        "ev",
    ),
)
def nested_cart_rebuild(spark, sf):
    """Two levels of arrays rebuilt from text, options with numeric ids."""
    df = _loaded(spark, sf, normalise_options=False)
    rows = df.select("_id", F.explode("cart_products").alias("c")).select("_id", "c.product_id", "c.amount", "c.price", F.explode("c.option").alias("o"))
    return rows.select("_id", "product_id", "amount", "price", "o.*")


@query(
    "random_sample",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity FROM lineitem
    ORDER BY ln((CAST('0x' || substr(md5('7|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / l_quantity DESC,
      l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000""",
)
def random_sample(spark, sf):
    """A thousand order lines, drawn with their quantity as weight."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    drawn = sampling.random_rows(lines, 1000, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 7, F.col("l_quantity"))
    return drawn.drop("l_suppkey")


@query(
    "check_declared_sources",
    duck(
        """SELECT *, failing = 0 AS passed FROM (
          SELECT 'events' AS table_name, '_id' AS column_name, 'unique' AS test, (SELECT CAST(count(*) AS BIGINT) FROM (SELECT _id FROM ev_dup GROUP BY 1 HAVING count(*) > 1)) AS failing
          UNION ALL SELECT 'events', '_id', 'not_null', (SELECT CAST(count(*) FILTER (_id IS NULL) AS BIGINT) FROM ev_dup)
          UNION ALL SELECT 'events', 'ingested_at', 'fresh', CAST(0 AS BIGINT)
          UNION ALL SELECT 'ip_locations', 'ip', 'not_null', (SELECT CAST(count(*) FILTER (ip IS NULL) AS BIGINT) FROM geo)
          UNION ALL SELECT 'ip_locations', 'ingested_at', 'fresh', CAST(1 AS BIGINT)
          UNION ALL SELECT 'products', 'product_id', 'unique', (SELECT CAST(count(*) AS BIGINT) FROM (SELECT product_id FROM prod_dup GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'products', 'product_id', 'not_null', (SELECT CAST(count(*) FILTER (product_id IS NULL) AS BIGINT) FROM prod_dup)
          UNION ALL SELECT 'products', 'ingested_at', 'fresh', CAST(0 AS BIGINT))""",
        "ev_dup",
        "geo",
        "prod_dup",
    ),
)
def check_declared_sources(spark, sf):
    """Declared tests of the raw tables on the fourth of February 2024: unique, not_null and fresh."""
    raw = {"events": raw_events(spark, sf, "ev_dup"), "ip_locations": raw_ip_locations(spark, sf), "products": raw_products(spark, sf, "prod_dup")}
    out = None
    for name, df in raw.items():
        one = schemas.check_declared(df, name, F.to_timestamp(F.lit("2024-02-04 00:00:00")))
        out = one if out is None else out.unionByName(one)
    return out
