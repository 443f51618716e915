"""Table profiles of the events, the addresses and the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.frames import raw_events, raw_ip_locations, raw_products
from orderloom.catalog.registry import query, scratch
from orderloom.catalog.standins import duck, table, view
from orderloom.functions.cleaning import percent
from orderloom.operators import discovery, estimates, profiling as p, sampling, structure
from orderloom.plans import reports
from orderloom.session import stored


def _pct(part: str, whole: str = "count(*)", digits: int = 2) -> str:
    scale = 10**digits
    return f"CAST((({part}) * {200 * scale} + {whole}) // ({whole} * 2) AS DOUBLE) / {scale}"


def _n(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _both(name: str, condition: str, digits: int = 2) -> str:
    return f"{_big(_n(condition))} AS {name}_count, {_pct(_n(condition), digits=digits)} AS {name}_pct"


def _present(c: str) -> str:
    return f"coalesce({c}, '') <> ''"


def _nulls(c: str, blank: bool) -> str:
    gone = f"coalesce({c}, '') = ''" if blank else f"{c} IS NULL"
    return f"{_big(_n(f'NOT ({gone})'))} AS non_null_{c}, {_big(_n(gone))} AS null_{c}_count, {_pct(_n(gone))} AS null_{c}_pct"


ROWS = "CAST(count(*) AS BIGINT) AS total_rows"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
NUMBER = "CASE WHEN regexp_matches({0}, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST({0} AS DOUBLE) END"


@query(
    "profile_partitions",
    duck(
        f"""(SELECT 'events' AS source, ingest_date AS partition_date, CAST(count(*) AS BIGINT) AS row_count, {_pct('count(_id)')} AS quality_pct
          FROM ev_dup GROUP BY 2 ORDER BY 2 DESC LIMIT 3)
        UNION ALL (SELECT 'products', ingest_date, CAST(count(*) AS BIGINT), {_pct(_n("status = 'success'"))} FROM prod_dup GROUP BY 2 ORDER BY 2 DESC LIMIT 3)
        UNION ALL (SELECT 'ip_locations', ingest_date, CAST(count(*) AS BIGINT), {_pct(_n(_present('country')))} FROM geo GROUP BY 2 ORDER BY 2 DESC LIMIT 3)""",
        "ev_dup",
        "prod_dup",
        "geo",
    ),
)
def profile_partitions(spark, sf):
    """Newest ingestion days of the three tables with a quality share."""
    checks = {
        "events": (raw_events(spark, sf, "ev_dup"), F.col("_id").isNotNull()),
        "products": (raw_products(spark, sf, "prod_dup"), F.col("status") == "success"),
        "ip_locations": (raw_ip_locations(spark, sf), p.has_value("country")),
    }
    out = None
    for name, (df, good) in checks.items():
        rows = p.partitions(df, 3, [percent(F.count_if(good), F.count("*")).alias("quality_pct")])
        rows = rows.select(F.lit(name).alias("source"), "partition_date", "row_count", "quality_pct")
        out = rows if out is None else out.unionByName(rows)
    return out


BASIC = f"""SELECT {{name}} AS source, {ROWS}, {_big('count(DISTINCT {key})')} AS distinct_keys, {_pct('count(DISTINCT {key})')} AS uniqueness_pct,
  min(ingest_date) AS earliest_ingestion_date, max(ingest_date) AS latest_ingestion_date,
  CAST(date_diff('day', min(ingest_date), max(ingest_date)) AS BIGINT) AS ingestion_period_days FROM {{view}}"""


@query(
    "profile_basic",
    duck(
        " UNION ALL ".join(
            BASIC.format(name=n, key=k, view=v)
            for n, k, v in (("'events'", "_id", "ev_dup"), ("'products'", "product_id", "prod_dup"), ("'ip_locations'", "ip", "geo"))
        ),
        "ev_dup",
        "prod_dup",
        "geo",
    ),
)
def profile_basic(spark, sf):
    """Rows, distinct keys and ingestion period of the three tables."""
    tables = {
        "events": (raw_events(spark, sf, "ev_dup"), "_id"),
        "products": (raw_products(spark, sf, "prod_dup"), "product_id"),
        "ip_locations": (raw_ip_locations(spark, sf), "ip"),
    }
    out = None
    for name, (df, key) in tables.items():
        one = p.basic(df, key).select(F.lit(name).alias("source"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "profile_nulls_core",
    duck(
        f"""SELECT {ROWS}, {_nulls('_id', False)}, {_nulls('collection', False)}, {_nulls('time_stamp', False)},
          {_big('count(DISTINCT _id)')} AS distinct__id, {_big('count(DISTINCT collection)')} AS distinct_collection FROM ev_dup""",
        "ev_dup",
    ),
)
def profile_nulls_core(spark, sf):
    return p.nulls(view(spark, sf, "ev_dup"), ["_id", "collection", "time_stamp"], distinct=["_id", "collection"])


BUSINESS = ("store_id", "product_id", "device_id", "user_id_db", "ip", "currency")


@query(
    "profile_nulls_business",
    duck(
        f"""SELECT {ROWS}, {', '.join(_nulls(c, c == 'user_id_db') for c in BUSINESS)},
          {', '.join(f'{_big(f"count(DISTINCT {c})")} AS distinct_{c}' for c in BUSINESS)} FROM ev""",
        "ev",
    ),
)
def profile_nulls_business(spark, sf):
    return p.nulls(view(spark, sf, "ev"), BUSINESS, blank_is_null=["user_id_db"], distinct=BUSINESS)


NO_PLACE = "coalesce(country, '') = '' AND coalesce(region, '') = '' AND coalesce(city, '') = ''"
FULL_PLACE = f"{_present('country')} AND {_present('region')} AND {_present('city')}"


@query(
    "profile_nulls_ip",
    duck(f"SELECT {ROWS}, {', '.join(_nulls(c, True) for c in ('ip', 'country', 'region', 'city'))}, {_both('no_geographic_data', NO_PLACE)} FROM geo", "geo"),
)
def profile_nulls_ip(spark, sf):
    return p.nulls(view(spark, sf, "geo"), ["ip", "country", "region", "city"], True, extra={"no_geographic_data": p.no_place()})


PRODUCT_COLUMNS = (
    "product_id", "url", "status", "product_name", "sku", "category", "category_name", "store_code", "currency_code",
    "price", "min_price", "max_price",
)


@query(
    "profile_nulls_product",
    duck(f"SELECT {ROWS}, {', '.join(_nulls(c, True) for c in PRODUCT_COLUMNS)}, {_both('http_status_missing', 'http_status IS NULL')} FROM prod", "prod"),
)
def profile_nulls_product(spark, sf):
    extra = {"http_status_missing": F.col("http_status").isNull()}
    return p.nulls(raw_products(spark, sf), PRODUCT_COLUMNS, True, extra=extra)


SAMPLED = ("product_id", "currency", "price", "order_id")


@query(
    "profile_nulls_sample",
    duck(
        f"SELECT {ROWS}, {', '.join(_nulls(c, True) for c in SAMPLED)} FROM ev WHERE CAST('0x' || md5(_id)[1:8] AS BIGINT) / 4294967296.0 < 0.5",
        "ev",
    ),
)
def profile_nulls_sample(spark, sf):
    """Null rates on the half of the events that a hash of the key picks."""
    return p.nulls_on_sample(view(spark, sf, "ev"), SAMPLED, 0.5, "_id")


PRICE = NUMBER.format("price")


@query(
    "price_stats",
    duck(
        f"""SELECT {ROWS}, {_nulls('price', False)}, min({PRICE}) AS min_price, max({PRICE}) AS max_price, round(avg({PRICE}), 2) AS avg_price,
          round(stddev_samp({PRICE}), 2) AS stddev_price, {_big(_n(f'{PRICE} <= 0'))} AS invalid_price_count,
          quantile_disc({PRICE}, 0.5) AS median_price FROM ev""",
        "ev",
    ),
)
def price_stats(spark, sf):
    return p.price_statistics(view(spark, sf, "ev"))


@query(
    "currency_price_stats",
    duck(
        f"""SELECT currency, CAST(count(*) AS BIGINT) AS row_count, {_big(_n(_present('price')))} AS with_price, round(avg({PRICE}), 2) AS avg_price,
          min({PRICE}) AS min_price, max({PRICE}) AS max_price, quantile_disc({PRICE}, 0.5) AS median_price FROM ev WHERE currency IS NOT NULL GROUP BY 1""",
        "ev",
    ),
)
def currency_price_stats(spark, sf):
    return p.price_by_group(view(spark, sf, "ev"), "currency", "price", {"median_price": "0.5"})


@query(
    "product_price_stats",
    duck(
        f"""SELECT currency_code, CAST(count(*) AS BIGINT) AS row_count, {_big(_n(_present('price')))} AS with_price, round(avg({PRICE}), 2) AS avg_price,
          min({PRICE}) AS min_price, max({PRICE}) AS max_price, round(avg({NUMBER.format('p.min_price')}), 2) AS avg_min_price,
          round(avg({NUMBER.format('p.max_price')}), 2) AS avg_max_price, quantile_disc({PRICE}, 0.25) AS p25_price,
          quantile_disc({PRICE}, 0.5) AS median_price, quantile_disc({PRICE}, 0.75) AS p75_price FROM prod p GROUP BY 1""",
        "prod",
    ),
)
def product_price_stats(spark, sf):
    quantiles = {"p25_price": "0.25", "median_price": "0.5", "p75_price": "0.75"}
    stats = p.price_by_group(view(spark, sf, "prod"), "currency_code", "price", quantiles, ["min_price", "max_price"])
    return stats


TIME = "to_timestamp(time_stamp) AT TIME ZONE 'UTC'"


@query(
    "profile_temporal",
    duck(
        f"""SELECT {ROWS}, {_big('count(time_stamp)')} AS non_null_timestamp, {_big(_n('time_stamp IS NULL'))} AS null_timestamp_count,
          {_pct(_n('time_stamp IS NULL'))} AS null_timestamp_pct, {STAMP.format(f'min({TIME})')} AS min_timestamp, {STAMP.format(f'max({TIME})')} AS max_timestamp,
          CAST(date_diff('day', min({TIME}), max({TIME})) AS BIGINT) AS timestamp_range_days, {_big(_n(f"{TIME} > TIMESTAMP '2024-01-20'"))} AS future_timestamps,
          {_big(_n(f"{TIME} < TIMESTAMP '2019-01-01'"))} AS pre_2019_timestamps, {STAMP.format('CAST(min(ingest_date) AS TIMESTAMP)')} AS min_ingested_at,
          {STAMP.format('CAST(max(ingest_date) AS TIMESTAMP)')} AS max_ingested_at FROM ev""",
        "ev",
    ),
)
def profile_temporal(spark, sf):
    return p.temporal(raw_events(spark, sf), F.to_timestamp(F.lit("2024-01-20")))


@query(
    "nested_field_profile",
    duck(
        f"""SELECT {ROWS}, {', '.join(f'''{_big(_n(f"{c}_n > 0"))} AS with_{c}, {_pct(_n(f"{c}_n > 0"))} AS with_{c}_pct, {_big(_n(f"{c}_n = 0"))} AS without_{c},
          {_pct(_n(f"{c}_n = 0"))} AS without_{c}_pct, {_pct(f'sum({c}_n)', f'(count({c}_n) * 100)')} AS avg_{c}, CAST(max({c}_n) AS BIGINT) AS max_{c},
          CAST(quantile_disc({c}_n, 0.5) AS BIGINT) AS median_{c}''' for c in ('option', 'cart_products'))}
        FROM (SELECT event_id % 4 AS option_n, CASE WHEN order_id <> '' THEN event_id % 3 ELSE 0 END AS cart_products_n FROM ev)""",
        "ev",
    ),
)
def nested_field_profile(spark, sf):
    return p.nested_lengths(raw_events(spark, sf), ["option", "cart_products"])


@query(
    "event_type_distribution",
    duck(
        f"""SELECT collection, CAST(count(*) AS BIGINT) AS row_count, {_big('count(DISTINCT device_id)')} AS sessions, {_big('count(DISTINCT product_id)')} AS products,
          {_pct('count(*)', '(SELECT count(*) FROM ev)')} AS percentage FROM ev GROUP BY 1""",
        "ev",
    ),
)
def event_type_distribution(spark, sf):
    extra = [F.count_distinct("device_id").alias("sessions"), F.count_distinct("product_id").alias("products")]
    return p.top_groups(view(spark, sf, "ev"), ["collection"], extra=extra)


@query(
    "top_stores",
    duck(
        f"""(SELECT 'events' AS source, store_id AS store, CAST(count(*) AS BIGINT) AS row_count, {_big('count(DISTINCT device_id)')} AS distinct_members,
          {_pct('count(*)', '(SELECT count(*) FROM ev)')} AS percentage FROM ev GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
        UNION ALL (SELECT 'products', store_code, CAST(count(*) AS BIGINT), {_big('count(DISTINCT category)')},
          {_pct('count(*)', '(SELECT count(*) FROM prod WHERE store_code IS NOT NULL)')} FROM prod WHERE store_code IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)""",
        "ev",
        "prod",
    ),
)
def top_stores(spark, sf):
    events = p.top_groups(view(spark, sf, "ev"), ["store_id"], 20, [F.count_distinct("device_id").alias("distinct_members")])
    listed = view(spark, sf, "prod").where(F.col("store_code").isNotNull())
    products = p.top_groups(listed, ["store_code"], 20, [F.count_distinct("category").alias("distinct_members")])
    one = events.select(F.lit("events").alias("source"), F.col("store_id").alias("store"), "row_count", "distinct_members", "percentage")
    two = products.select(F.lit("products").alias("source"), F.col("store_code").alias("store"), "row_count", "distinct_members", "percentage")
    return one.unionByName(two)


BAD_STORE = "CAST(store_id AS BIGINT) NOT BETWEEN 1 AND 86"


@query(
    "dq_issues_events",
    duck(
        f"""SELECT {_big('count(*) - count(DISTINCT _id)')} AS duplicate_event_ids_count, {_pct('count(*) - count(DISTINCT _id)', digits=4)} AS duplicate_event_ids_pct,
          {_both('future_timestamps', f"{TIME} > TIMESTAMP '2024-01-20'", 4)}, {_both('very_old_timestamps', f"{TIME} < TIMESTAMP '2019-01-01'", 4)},
          {_both('invalid_store_ids', BAD_STORE, 4)}, {_both('missing_critical_fields', '_id IS NULL OR collection IS NULL OR time_stamp IS NULL', 4)},
          {_both('invalid_prices', f'{PRICE} <= 0', 4)} FROM ev_dup""",
        "ev_dup",
    ),
)
def dq_issues_events(spark, sf):
    return p.event_issues(view(spark, sf, "ev_dup"), F.to_timestamp(F.lit("2024-01-20")))


@query("invalid_store_ids", duck(f"SELECT store_id, CAST(count(*) AS BIGINT) AS n FROM ev WHERE {BAD_STORE} GROUP BY 1", "ev"))
def invalid_store_ids(spark, sf):
    return view(spark, sf, "ev").where(p.store_out_of_range()).groupBy("store_id").agg(F.count("*").alias("n"))


IPV4 = "regexp_matches(ip, '^[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}$')"
IPV6 = "contains(ip, ':')"


@query(
    "dq_issues_ip",
    duck(
        f"""SELECT {ROWS}, {_both('missing_ip', "coalesce(ip, '') = ''")}, {_both('no_geographic_data', NO_PLACE)},
          {_big(_n(f"{_present('ip')} AND NOT {IPV4} AND NOT {IPV6}"))} AS invalid_ip_formats,
          {_big(_n(f"{_present('country')} AND length(country) <= 1"))} AS suspicious_country_values,
          {_big(_n(f"{_present('city')} AND length(city) <= 1"))} AS suspicious_city_values,
          {_big(_n("country = '-' OR city = '-' OR region = '-'"))} AS placeholder_values FROM geo""",
        "geo",
    ),
)
def dq_issues_ip(spark, sf):
    return p.ip_issues(view(spark, sf, "geo"))


@query(
    "dq_issues_product",
    duck(
        f"""SELECT {ROWS}, {_big(_n("coalesce(product_id, '') = ''"))} AS missing_product_id, {_big('count(*) - count(DISTINCT product_id)')} AS duplicate_product_ids,
          {_pct('count(*) - count(DISTINCT product_id)')} AS duplicate_pct, {_big(_n("status <> 'success'"))} AS failed_crawls,
          {_pct(_n("status <> 'success'"))} AS failed_crawl_pct, {_big(_n("coalesce(product_id, '') = '' OR coalesce(url, '') = ''"))} AS products_missing_identifiers,
          {_big(_n(f"{_present('price')} AND {PRICE} <= 0"))} AS invalid_prices, {_big(_n(f"{_present('price')} AND NOT {_present('currency_code')}"))} AS price_without_currency,
          {_big(_n(f"{_present('product_name')} AND length(product_name) < 3"))} AS very_short_names, {_big(_n(f"NOT {_present('category')}"))} AS no_category,
          {_big(_n(f"NOT {_present('primary_image_url')}"))} AS no_image FROM prod_dup""",
        "prod_dup",
    ),
)
def dq_issues_product(spark, sf):
    return p.product_issues(view(spark, sf, "prod_dup"))


@query(
    "bot_sessions",
    duck(
        f"""SELECT {_big('count(*)')} AS suspicious_large_sessions, {_big('min(n)')} AS min_session_size, {_big('max(n)')} AS max_session_size,
          {_pct('sum(n)', '(count(n) * 100)')} AS avg_session_size FROM (SELECT device_id, count(*) AS n FROM ev GROUP BY 1 HAVING count(*) > 5)""",
        "ev",
    ),
)
def bot_sessions(spark, sf):
    return p.bot_sessions(view(spark, sf, "ev"), more_than=5)


@query(
    "daily_activity",
    duck(
        f"""SELECT CAST({TIME} AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS event_count, {_big('count(DISTINCT device_id)')} AS sessions,
          {_big('count(DISTINCT user_id_db)')} AS active_users, {_big('count(DISTINCT ip)')} AS unique_ips FROM ev GROUP BY 1""",
        "ev",
    ),
)
def daily_activity(spark, sf):
    ev = view(spark, sf, "ev").where(F.col("time_stamp").isNotNull())
    return ev.groupBy(F.to_date(F.timestamp_seconds("time_stamp")).alias("event_date")).agg(
        F.count("*").alias("event_count"), F.count_distinct("device_id").alias("sessions"),
        F.count_distinct("user_id_db").alias("active_users"), F.count_distinct("ip").alias("unique_ips"),
    )


PK = f"""SELECT {{name}} AS source, {ROWS}, {_big('count(DISTINCT {key})')} AS distinct_keys, {_big('count(*) - count(DISTINCT {key})')} AS duplicate_count,
  {_pct('count(*) - count(DISTINCT {key})')} AS duplicate_pct, {_big(_n("coalesce({key}, '') = ''"))} AS null_count,
  {_pct(_n("coalesce({key}, '') = ''"))} AS null_pct, {_pct('count(DISTINCT {key})')} AS uniqueness_rate FROM {{view}}"""


@query(
    "profile_primary_key",
    duck(
        " UNION ALL ".join(
            PK.format(name=n, key=k, view=v)
            for n, k, v in (("'events'", "_id", "ev_dup"), ("'products'", "product_id", "prod_dup"), ("'ip_locations'", "ip", "geo"))
        ),
        "ev_dup",
        "prod_dup",
        "geo",
    ),
)
def profile_primary_key(spark, sf):
    out = None
    for name, source, key in (("events", "ev_dup", "_id"), ("products", "prod_dup", "product_id"), ("ip_locations", "geo", "ip")):
        one = p.primary_key(view(spark, sf, source), key, True).select(F.lit(name).alias("source"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "top_duplicates",
    duck(
        f"""(SELECT 'events' AS source, _id AS key, CAST(count(*) AS BIGINT) AS occurrences, min(price) AS first_value, max(price) AS last_value
          FROM ev_dup GROUP BY 2 HAVING count(*) > 1 ORDER BY 3 DESC, 2 LIMIT 10)
        UNION ALL (SELECT 'products', product_id, CAST(count(*) AS BIGINT), min(product_name), max(product_name)
          FROM prod_dup GROUP BY 2 HAVING count(*) > 1 ORDER BY 3 DESC, 2 LIMIT 20)
        UNION ALL (SELECT 'ip_locations', ip, CAST(count(*) AS BIGINT), min(nullif(country, '')), max(nullif(country, ''))
          FROM geo GROUP BY 2 HAVING count(*) > 1 ORDER BY 3 DESC, 2 LIMIT 20)""",
        "ev_dup",
        "prod_dup",
        "geo",
    ),
)
def top_duplicates(spark, sf):
    out = None
    for name, source, key, value, size in (
        ("events", "ev_dup", "_id", F.col("price"), 10),
        ("products", "prod_dup", "product_id", F.col("product_name"), 20),
        ("ip_locations", "geo", "ip", F.nullif("country", F.lit("")), 20),
    ):
        extra = [F.min(value).alias("first_value"), F.max(value).alias("last_value")]
        one = p.top_duplicates(view(spark, sf, source), key, size, extra, skip_blank=True)
        one = one.select(F.lit(name).alias("source"), F.col(key).alias("key"), "occurrences", "first_value", "last_value")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "rule_price_currency",
    duck(
        f"""SELECT {_big('count(price)')} AS events_with_price, {_big(_n('price IS NOT NULL AND currency IS NOT NULL'))} AS events_with_both,
          {_big(_n('price IS NOT NULL AND currency IS NULL'))} AS violation_count, {_pct(_n('price IS NOT NULL AND currency IS NULL'), 'count(price)')} AS violation_pct,
          {_pct(_n('price IS NOT NULL AND currency IS NOT NULL'), 'count(price)')} AS compliance_rate FROM ev""",
        "ev",
    ),
)
def rule_price_currency(spark, sf):
    return p.price_currency_rule(view(spark, sf, "ev"))


def _crosstab(column: str) -> str:
    return duck(
        f"""SELECT collection, CAST(count(*) AS BIGINT) AS row_count, {_both('present', f'{column} IS NOT NULL')}, {_both('absent', f'{column} IS NULL')}
        FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "ev",
    )


@query("crosstab_type_product", _crosstab("product_id"))
def crosstab_type_product(spark, sf):
    c = F.col("product_id")
    return p.crosstab_presence(view(spark, sf, "ev"), "collection", {"present": c.isNotNull(), "absent": c.isNull()}, 10)


@query("crosstab_type_price", _crosstab("price"))
def crosstab_type_price(spark, sf):
    c = F.col("price")
    return p.crosstab_presence(view(spark, sf, "ev"), "collection", {"present": c.isNotNull(), "absent": c.isNull()}, 10)


@query(
    "geo_coverage",
    duck(
        f"""SELECT {', '.join(f"{_big(f'count(DISTINCT {c})')} AS distinct_{n}, {_big(f'count(DISTINCT CASE WHEN {_present(c)} THEN {c} END)')} AS distinct_non_empty_{n}"
            for c, n in (('country', 'countries'), ('region', 'regions'), ('city', 'cities')))},
          {_big(f'count(DISTINCT CASE WHEN {FULL_PLACE} THEN ip END)')} AS ips_with_complete_data,
          {_pct(f'count(DISTINCT CASE WHEN {FULL_PLACE} THEN ip END)', 'count(DISTINCT ip)')} AS complete_data_pct FROM geo""",
        "geo",
    ),
)
def geo_coverage(spark, sf):
    return p.geo_coverage(view(spark, sf, "geo"))


@query(
    "top_countries",
    duck(
        f"""SELECT country, CAST(count(*) AS BIGINT) AS row_count, {_big('count(DISTINCT ip)')} AS distinct_ips,
          {_pct('count(*)', f"(SELECT count(*) FROM geo WHERE {_present('country')})")} AS percentage FROM geo WHERE {_present('country')}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "geo",
    ),
)
def top_countries(spark, sf):
    named = view(spark, sf, "geo").where(p.has_value("country"))
    return p.top_groups(named, ["country"], 20, [F.count_distinct("ip").alias("distinct_ips")])


@query(
    "ip_format_profile",
    duck(f"SELECT {ROWS}, {_both('ipv4_format', IPV4)}, {_both('ipv6_format', IPV6)}, {_both('invalid_format', f'NOT {IPV4} AND NOT {IPV6}')} FROM geo", "geo"),
)
def ip_format_profile(spark, sf):
    return p.ip_formats(view(spark, sf, "geo"))


PRIVATE = "regexp_matches(ip, '^(10[.]|172[.](1[6-9]|2[0-9]|3[01])[.]|192[.]168[.])')"


@query(
    "ip_private_public",
    duck(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_ips, {_both('private_ips', PRIVATE)}, {_both('localhost_ips', "starts_with(ip, '127.')")},
          {_both('public_ips', f"NOT {PRIVATE} AND NOT starts_with(ip, '127.')")} FROM geo WHERE {IPV4}""",
        "geo",
    ),
)
def ip_private_public(spark, sf):
    return p.ip_kinds(view(spark, sf, "geo"))


def _length(c: str, skip_blank: bool) -> str:
    value = f"length(nullif({c}, ''))" if skip_blank else f"length({c})"
    return f"{_pct(f'sum({value})', f'(count({value}) * 100)')} AS avg_{c}_length, {_big(f'min({value})')} AS min_{c}_length, {_big(f'max({value})')} AS max_{c}_length"


@query(
    "string_length_profile",
    duck(
        f"""SELECT * FROM (SELECT {', '.join(_length(c, c != 'ip') for c in ('ip', 'country', 'region', 'city'))} FROM geo)
        CROSS JOIN (SELECT {', '.join(_length(c, False) for c in ('product_name', 'url', 'sku', 'category_name'))} FROM prod)""",
        "geo",
        "prod",
    ),
)
def string_length_profile(spark, sf):
    """Text lengths of addresses and of the catalogue in one row."""
    ips = p.string_lengths(view(spark, sf, "geo"), ["ip", "country", "region", "city"], ["country", "region", "city"])
    products = p.string_lengths(view(spark, sf, "prod"), ["product_name", "url", "sku", "category_name"])
    picks = {c: products.select(c).scalar() for c in products.columns}
    return ips.withColumns(picks)


@query(
    "geo_levels_distribution",
    duck(
        f"""SELECT {_both('level0_no_data', NO_PLACE)}, {_both('level1_country_only', f"{_present('country')} AND NOT {_present('region')} AND NOT {_present('city')}")},
          {_both('level2_country_region', f"{_present('country')} AND {_present('region')} AND NOT {_present('city')}")}, {_both('level3_complete', FULL_PLACE)} FROM geo""",
        "geo",
    ),
)
def geo_levels_distribution(spark, sf):
    return p.geo_levels(view(spark, sf, "geo"))


@query(
    "country_summary",
    duck(
        f"""SELECT country, CAST(count(*) AS BIGINT) AS total_ips, {_big('count(DISTINCT ip)')} AS distinct_ips, {_big('count(DISTINCT region)')} AS distinct_regions,
          {_big('count(DISTINCT city)')} AS distinct_cities, {_pct(_n(_present('region')))} AS region_populated_pct, {_pct(_n(_present('city')))} AS city_populated_pct
        FROM geo WHERE {_present('country')} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "geo",
    ),
)
def country_summary(spark, sf):
    return p.country_summary(view(spark, sf, "geo"))


def _share(column: str, where: str) -> str:
    return f"""SELECT '{column}' AS field, CAST({column} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n,
      {_pct('count(*)', f'(SELECT count(*) FROM prod WHERE {where})')} AS percentage FROM prod WHERE {where} GROUP BY 2"""


@query("crawl_status_distribution", duck(_share("status", "TRUE") + " UNION ALL " + _share("http_status", "http_status IS NOT NULL"), "prod"))
def crawl_status_distribution(spark, sf):
    return _shares(view(spark, sf, "prod"), ("status", "http_status"))


@query("share_of_total", duck(_share("product_type", "product_type IS NOT NULL") + " UNION ALL " + _share("gender", "gender IS NOT NULL"), "prod"))
def share_of_total(spark, sf):
    return _shares(view(spark, sf, "prod"), ("product_type", "gender"))


def _shares(df, columns):
    out = None
    for name in columns:
        one = reports.share_of_total(df.where(F.col(name).isNotNull()), [name])
        one = one.select(F.lit(name).alias("field"), F.col(name).cast("string").alias("value"), "n", "percentage")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "category_distribution",
    duck(
        f"""SELECT category, category_name, CAST(count(*) AS BIGINT) AS row_count, {_big('count(DISTINCT store_code)')} AS stores_with_category,
          {_pct('count(*)', '(SELECT count(*) FROM prod WHERE category IS NOT NULL)')} AS percentage FROM prod WHERE category IS NOT NULL
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
        "prod",
    ),
)
def category_distribution(spark, sf):
    rows = view(spark, sf, "prod").where(F.col("category").isNotNull())
    return p.top_groups(rows, ["category", "category_name"], 20, [F.count_distinct("store_code").alias("stores_with_category")])


@query(
    "url_format_profile",
    duck(
        f"""SELECT {ROWS}, {_big(_n("url LIKE 'http%'"))} AS urls_with_http, {_big(_n("url LIKE 'https%'"))} AS urls_with_https, {_pct(_n("url LIKE 'https%'"))} AS https_pct,
          {_big(_n(_present('primary_image_url')))} AS products_with_image, {_big(_n("primary_image_url LIKE 'https%'"))} AS images_with_https,
          {_big(_n(_present('primary_video_url')))} AS products_with_video, {_big(_n(f"{_present('url')} AND {_present('primary_image_url')}"))} AS products_with_url_and_image FROM prod""",
        "prod",
    ),
)
def url_format_profile(spark, sf):
    return p.url_formats(view(spark, sf, "prod"))


@query(
    "rule_price_consistency",
    duck(
        f"""SELECT {ROWS}, {_big(_n('lo IS NOT NULL AND pr IS NOT NULL AND hi IS NOT NULL'))} AS records_with_all_prices, {_big(_n('lo > pr'))} AS min_price_exceeds_price,
          {_big(_n('pr > hi'))} AS price_exceeds_max_price, {_big(_n('lo > hi'))} AS min_exceeds_max,
          {_big(_n(f"status = 'success' AND NOT {_present('product_name')}"))} AS success_but_no_name,
          {_big(_n(f"status = 'success' AND NOT {_present('price')}"))} AS success_but_no_price
        FROM (SELECT *, {NUMBER.format('min_price')} AS lo, {PRICE} AS pr, {NUMBER.format('max_price')} AS hi FROM prod)""",
        "prod",
    ),
)
def rule_price_consistency(spark, sf):
    return p.price_consistency(view(spark, sf, "prod"))


COMPLETE = {"name": "product_name", "price": "price", "category": "category", "image": "primary_image_url"}


@query(
    "crosstab_status_completeness",
    duck(
        f"""SELECT status, CAST(count(*) AS BIGINT) AS row_count, {', '.join(_both(n, _present(c)) for n, c in COMPLETE.items())} FROM prod GROUP BY 1""",
        "prod",
    ),
)
def crosstab_status_completeness(spark, sf):
    return p.crosstab_presence(view(spark, sf, "prod"), "status", {n: p.has_value(c) for n, c in COMPLETE.items()})


@query(
    "crosstab_category_store",
    duck(
        f"""SELECT category_name, {_big('count(DISTINCT store_code)')} AS stores_with_category, CAST(count(*) AS BIGINT) AS total_products,
          (SELECT string_agg(s, ', ' ORDER BY s) FROM (SELECT DISTINCT store_code AS s FROM prod q WHERE q.category_name = c.category_name AND store_code IS NOT NULL ORDER BY s LIMIT 5)) AS sample_stores
        FROM prod c WHERE category_name IS NOT NULL AND store_code IS NOT NULL GROUP BY category_name ORDER BY 3 DESC, 1 LIMIT 20""",
        "prod",
    ),
)
def crosstab_category_store(spark, sf):
    rows = view(spark, sf, "prod").where(F.col("category_name").isNotNull() & F.col("store_code").isNotNull())
    counts = rows.groupBy("category_name").agg(
        F.count_distinct("store_code").alias("stores_with_category"), F.count("*").alias("total_products")
    )
    top = counts.orderBy(F.col("total_products").desc(), "category_name").limit(20)
    return top.join(p.joined_values(rows, ["category_name"], "store_code", "sample_stores", 5), "category_name")


@query(
    "ip_coverage",
    duck(
        f"""SELECT {_big('count(DISTINCT e.ip)')} AS event_distinct_ips, {_big('count(DISTINCT l.ip)')} AS ip_locations_distinct_ips,
          {_big('count(DISTINCT CASE WHEN l.ip IS NOT NULL THEN e.ip END)')} AS matched_ips, {_pct('count(DISTINCT l.ip)', 'count(DISTINCT e.ip)')} AS coverage_pct
        FROM ev e LEFT JOIN (SELECT * FROM geo WHERE country <> '') l ON e.ip = l.ip""",
        "ev",
        "geo",
    ),
)
def ip_coverage(spark, sf):
    return p.ip_coverage(view(spark, sf, "ev"), view(spark, sf, "geo").where(F.col("country") != ""))


@query(
    "column_metadata",
    """SELECT 'orders' AS table_name, c AS column_name, CAST(i AS BIGINT) AS ordinal_position, t AS data_type, 'SCALAR' AS field_mode, TRUE AS is_nullable,
      CAST(n AS BIGINT) AS filled_rows FROM (
      SELECT 'o_orderkey' AS c, 1 AS i, 'bigint' AS t, (SELECT count(o_orderkey) FROM orders) AS n
      UNION ALL SELECT 'o_custkey', 2, 'bigint', (SELECT count(o_custkey) FROM orders) UNION ALL SELECT 'o_orderstatus', 3, 'string', (SELECT count(o_orderstatus) FROM orders)
      UNION ALL SELECT 'o_totalprice', 4, 'double', (SELECT count(o_totalprice) FROM orders) UNION ALL SELECT 'o_orderdate', 5, 'timestamp_ntz', (SELECT count(o_orderdate) FROM orders)
      UNION ALL SELECT 'o_orderpriority', 6, 'string', (SELECT count(o_orderpriority) FROM orders))""",
)
def column_metadata(spark, sf):
    return p.column_metadata(table(spark, sf, "orders"), "orders")


@query(
    "table_metadata",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, true AS has_bytes FROM {t}" for t in ("events", "orders", "lineitem")
    ),
)
def table_metadata(spark, sf):
    """Rows of three tables, and whether their files tell a size (sizes themselves are no SQL matter)."""
    out = None
    for name in ("events", "orders", "lineitem"):
        one = p.file_metadata(table(spark, sf, name), name)
        out = one if out is None else out.unionByName(one)
    return out.select("table_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


# All nodes of all documents. Objects inside arrays are not fields of their own, their members are.
TREE = r"""SELECT l.event_id, l.line, regexp_replace(regexp_replace(replace(t.fullkey, '"', ''), '^\$\.', ''), '\[\d+\]', '[]', 'g') AS path,
  CASE t.type WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN 'bool' WHEN 'VARCHAR' THEN 'string' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object'
    WHEN 'DOUBLE' THEN 'float' ELSE 'int' END AS kind
FROM (SELECT event_id, line FROM jsonl WHERE trim(line) <> '') l, json_tree(l.line) t
WHERE t.fullkey <> '$' AND NOT (t.type = 'OBJECT' AND t.fullkey LIKE '%]')"""


@query(
    "discover_field_types",
    duck(
        """SELECT path, occurrences, array_to_string(kinds, ',') AS kinds,
          CASE WHEN len(kinds) = 0 THEN 'STRING' WHEN kinds = ['float', 'int'] THEN 'FLOAT64' WHEN len(kinds) > 1 THEN 'STRING (mixed types)'
            ELSE CASE kinds[1] WHEN 'bool' THEN 'BOOL' WHEN 'int' THEN 'INT64' WHEN 'float' THEN 'FLOAT64' WHEN 'string' THEN 'STRING'
              WHEN 'array' THEN 'ARRAY/REPEATED' ELSE 'RECORD/STRUCT' END END AS recommended_type
        FROM (SELECT path, CAST(count(*) AS BIGINT) AS occurrences, coalesce(list_sort(list(DISTINCT kind) FILTER (kind IS NOT NULL)), []) AS kinds FROM tree GROUP BY path)""",
        "jsonl",
        tree=TREE,
    ),
)
def discover_field_types(spark, sf):
    """Kinds and proposed column type of every JSON field."""
    from orderloom.catalog.loads import _lines
    from orderloom.sources.jsonl import not_blank

    return discovery.recommended_types(discovery.field_counts(not_blank(_lines(spark, sf))))


@query(
    "field_presence_by_type",
    duck(
        "SELECT json_extract_string(line, '$.collection') AS collection, path, CAST(count(*) AS BIGINT) AS occurrences FROM tree GROUP BY 1, 2",
        "jsonl",
        tree=TREE,
    ),
)
def field_presence_by_type(spark, sf):
    """How often every field occurs in each event type."""
    from orderloom.catalog.loads import _lines
    from orderloom.functions.documents import json_scalar
    from orderloom.sources.jsonl import not_blank

    lines = not_blank(_lines(spark, sf)).withColumn("collection", json_scalar("line", "$.collection"))
    fields = discovery.field_counts(lines, carry=("collection",))
    return fields.groupBy("collection", "path").agg(F.sum("occurrences").alias("occurrences"))


@query(
    "estimated_counts",
    duck(
        """SELECT c AS column_name, CAST(n AS BIGINT) AS row_count, CAST(f AS BIGINT) AS filled, CAST(d AS BIGINT) AS exact_distinct, TRUE AS within_bound, TRUE AS rows_from_footers FROM (
          SELECT '_id' AS c, count(*) AS n, count(_id) AS f, count(DISTINCT _id) AS d FROM ev UNION ALL SELECT 'device_id', count(*), count(device_id), count(DISTINCT device_id) FROM ev
          UNION ALL SELECT 'ip', count(*), count(ip), count(DISTINCT ip) FROM ev UNION ALL SELECT 'product_id', count(*), count(product_id), count(DISTINCT product_id) FROM ev)""",
        "ev",
    ),
)
def estimated_counts(spark, sf):
    """Rows from footers, and distinct values from daily sketches of two loads, held against the exact counts."""
    names, day = ["_id", "device_id", "ip", "product_id"], F.to_date(F.timestamp_seconds("time_stamp"))
    events, path = view(spark, sf, "ev").select(*names, "time_stamp"), scratch(spark)
    half = events.agg(F.percentile_approx("time_stamp", 0.5)).first()[0]
    first = events.where(day < F.to_date(F.timestamp_seconds(F.lit(half))))
    estimates.daily_sketches(first, day, names).write.parquet(path)
    later = estimates.new_days(spark.read.parquet(path), events, day)
    stored(estimates.daily_sketches(later, day, names)).write.mode("append").parquet(path)
    counts = estimates.merged_counts(spark.read.parquet(path))
    exact = p.cardinality(events, names).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"distinct_{c}").alias("exact_distinct")) for c in names])).alias("e")
    ).select("e.*")
    rows = estimates.footer_rows(table(spark, sf, "events"))
    near = F.abs(F.col("distinct_estimate") - F.col("exact_distinct")) <= estimates.ERROR_BOUND * F.col("exact_distinct")
    return counts.join(exact, "column_name").select(
        "column_name", F.col("rows").alias("row_count"), "filled", "exact_distinct", near.alias("within_bound"), (F.col("rows") == rows).alias("rows_from_footers")
    )


# Options: event_id % 4 each. Cart lines: event_id % 3 of checkouts.
_PATHS = [
    ("_id", 1, "string", "SCALAR", "count(_id)", "min(_id)"),
    ("option", 1, "array", "REPEATED", "count(*) FILTER (event_id % 4 > 0)", "NULL"),
    *[
        (f"option[].{c}", 2, "string", "SCALAR", "sum(event_id % 4)" if v else "count(*) FILTER (false)", f"'{v}'" if v else "NULL")
        for c, v in (("option_id", ""), ("option_label", "alloy"), ("value_id", ""), ("value_label", "gold"), ("quality", ""), ("quality_label", ""))
    ],
    ("cart_products", 1, "array", "REPEATED", "count(*) FILTER (lines > 0)", "NULL"),
    ("cart_products[].product_id", 2, "bigint", "SCALAR", "sum(lines)", "min(CAST(event_id % 500 AS VARCHAR)) FILTER (lines > 0)"),
    ("cart_products[].amount", 2, "bigint", "SCALAR", "sum(lines)", "min('1') FILTER (lines > 0)"),
    ("cart_products[].price", 2, "string", "SCALAR", "coalesce(sum(lines) FILTER (price IS NOT NULL), 0)", "min(price) FILTER (lines > 0)"),
    ("cart_products[].currency", 2, "string", "SCALAR", "coalesce(sum(lines) FILTER (currency IS NOT NULL), 0)", "min(currency) FILTER (lines > 0)"),
    ("cart_products[].option", 2, "array", "REPEATED", "count(*) FILTER (false)", "NULL"),
    *[
        (f"cart_products[].option[].{c}", 3, t, "SCALAR", "count(*) FILTER (false)", "NULL")
        for c, t in (("option_id", "bigint"), ("option_label", "string"), ("value_id", "bigint"), ("value_label", "string"))
    ],
]


@query(
    "nested_column_metadata",
    duck(
        " UNION ALL ".join(
            f"""SELECT 'events' AS table_name, '{path}' AS path, CAST({i} AS BIGINT) AS ordinal_position, CAST({depth} AS BIGINT) AS depth, '{kind}' AS data_type,
            '{mode}' AS field_mode, CAST({n} AS BIGINT) AS filled_values, CAST({sample} AS VARCHAR) AS sample FROM carts"""
            for i, (path, depth, kind, mode, n, sample) in enumerate(_PATHS, 1)
        ),
        "ev",
        carts="SELECT *, CASE WHEN order_id <> '' THEN event_id % 3 ELSE 0 END AS lines FROM ev",
    ),
)
def nested_column_metadata(spark, sf):
    """Every field of the nested events with its depth, filled values and a sample."""
    events = raw_events(spark, sf).select("_id", "option", "cart_products")
    return structure.nested_columns(events, "events").drop("is_nullable")


@query(
    "column_count_summary",
    """SELECT table_name, CAST(count(*) AS BIGINT) AS total_columns, CAST(count(*) FILTER (is_nullable = 'YES') AS BIGINT) AS nullable_columns,
      CAST(count(*) FILTER (is_nullable = 'NO') AS BIGINT) AS non_nullable_columns, CAST(0 AS BIGINT) AS nested_columns, CAST(count(*) AS BIGINT) AS total_fields
    FROM information_schema.columns WHERE table_name IN ('events', 'orders', 'customer') GROUP BY 1""",
)
def column_count_summary(spark, sf):
    out = None
    for name in ("events", "orders", "customer"):
        one = structure.column_summary(table(spark, sf, name), name)
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "missing_names_sample",
    duck(
        f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM prod) AS total_rows, (SELECT {_big(_n("product_name = ''"))} FROM prod) AS offending_rows,
          (SELECT {_pct(_n("product_name = ''"))} FROM prod) AS offending_pct, product_id, url FROM prod WHERE product_name = '' ORDER BY product_id LIMIT 5""",
        "prod",
    ),
)
def missing_names_sample(spark, sf):
    """How many products lack a name, and the first five of them."""
    gone = ~p.has_value("product_name")
    return sampling.offending_sample(view(spark, sf, "prod"), gone, 5, ["product_id"], ["product_id", "url"])
