"""Dimensions, the sales fact, and the checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.cleaning import AGENT, ITEMS, PICKED, STG_IP, STG_PRODUCTS
from orderloom.catalog.frames import distinct_checkouts, raw_ip_locations, raw_products, staged_checkouts
from orderloom.catalog.registry import query
from orderloom.catalog.standins import duck, table, view
from orderloom.operators import checks
from orderloom.plans import core, intermediate, staging
from orderloom.session import packed

DATE_ORACLE = """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, CAST(year(d) AS BIGINT) AS year,
  CAST(date_trunc('year', d) AS DATE) AS year_start_date, make_date(year(d), 12, 31) AS year_end_date,
  (year(d) % 4 = 0 AND (year(d) % 100 <> 0 OR year(d) % 400 = 0)) AS is_leap_year,
  CAST(quarter(d) AS BIGINT) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
  CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(month(d) AS BIGINT) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
  CAST(day(last_day(d)) AS BIGINT) AS days_in_month, d = last_day(d) AS is_last_day_of_month,
  CAST(strftime(d, '%U') AS BIGINT) AS week, CAST(strftime(d, '%V') AS BIGINT) AS iso_week, CAST(strftime(d, '%G') AS BIGINT) AS iso_year,
  CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week_end_date,
  CAST(ceil(day(d) / 7.0) AS BIGINT) AS week_of_month, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
  strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_name_short, CAST(day(d) AS BIGINT) AS day_of_month,
  CAST(dayofyear(d) AS BIGINT) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  d = DATE '1998-05-17' AS is_current_day, date_trunc('month', d) = DATE '1998-05-01' AS is_current_month,
  date_trunc('quarter', d) = DATE '1998-04-01' AS is_current_quarter, date_trunc('year', d) = DATE '1998-01-01' AS is_current_year
FROM days"""
DAYS = "SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem"


@query("dim_date", duck(DATE_ORACLE, days=DAYS))
def dim_date(spark, sf):
    """Calendar attributes of every order and shipping day."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date_day"))
    shipped = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date_day"))
    days = orders.unionByName(shipped).distinct()
    return core.date_rows(days, "date_day", F.lit("1998-05-17").cast("date"))


DIM_PRODUCT = """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, url, product_name, sku, product_type, collection_name,
  gender, category_id, category_name, currency_code, price, min_price, max_price, gold_weight FROM stg_products
UNION ALL SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown Product', 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', '-1', 'Unknown', 'USD', 0, 0, 0, 0
UNION ALL SELECT -2, 'N/A', 'N/A', 'Not Applicable', 'N/A', 'N/A', 'N/A', 'N/A', '-2', 'N/A', 'USD', 0, 0, 0, 0"""


@query("dim_product", duck("SELECT * REPLACE (CAST(product_key AS BIGINT) AS product_key) FROM dim_product", "prod_dup", stg_products=STG_PRODUCTS, dim_product=DIM_PRODUCT))
def dim_product(spark, sf):
    return core.dim_product(staging.stg_products(raw_products(spark, sf, "prod_dup")))


DIM_LOCATION = """SELECT row_number() OVER (ORDER BY country_name, region_name NULLS FIRST, city_name NULLS FIRST) AS location_key, * FROM
  (SELECT DISTINCT country_name, region_name, city_name, geo_completeness_level FROM stg_ip WHERE country_name IS NOT NULL)
UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', -1 UNION ALL SELECT -2, 'N/A', 'N/A', 'N/A', -2"""


def _places(spark, sf):
    return staging.stg_ip_locations(raw_ip_locations(spark, sf), tie_break=["c_custkey"])


@query("dim_location", duck("SELECT * REPLACE (CAST(location_key AS BIGINT) AS location_key) FROM dim_location", "geo", stg_ip=STG_IP, dim_location=DIM_LOCATION))
def dim_location(spark, sf):
    return core.dim_location(_places(spark, sf))


@query(
    "dim_with_unknown_members",
    duck("SELECT CAST(location_key AS BIGINT) AS location_key, country_name FROM dim_location WHERE location_key < 0 OR city_name IS NULL", "geo", stg_ip=STG_IP, dim_location=DIM_LOCATION),
)
def dim_with_unknown_members(spark, sf):
    """The fixed members next to places without a city."""
    dim = core.dim_location(_places(spark, sf))
    return dim.where((F.col("location_key") < 0) | F.col("city_name").isNull()).select("location_key", "country_name")


DIM_DEVICE = f"""SELECT row_number() OVER (ORDER BY device_category, browser_name, operating_system) AS device_key, *,
  device_category IN ('Mobile', 'Tablet') AS is_mobile FROM (SELECT DISTINCT {AGENT} FROM {{source}})
UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', FALSE UNION ALL SELECT -2, 'N/A', 'N/A', 'N/A', FALSE"""


@query("dim_device", duck("SELECT * REPLACE (CAST(device_key AS BIGINT) AS device_key) FROM dim_device", "checkout", dim_device=DIM_DEVICE.format(source="checkout")))
def dim_device(spark, sf):
    return core.dim_device(intermediate.checkout_success(staged_checkouts(spark, sf)))


DIM_FX = """SELECT row_number() OVER (ORDER BY currency_code, rate_to_usd) AS exchange_rate_key, currency_code, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd
FROM (SELECT DISTINCT currency_code, rate_to_usd FROM fx WHERE currency_code NOT IN ('', 'UNDEFINED'))
UNION ALL SELECT -1, 'UNKNOWN', 1 UNION ALL SELECT -2, 'N/A', 1"""


@query("dim_exchange_rate", duck("SELECT * REPLACE (CAST(exchange_rate_key AS BIGINT) AS exchange_rate_key) FROM dim_fx", "fx", dim_fx=DIM_FX))
def dim_exchange_rate(spark, sf):
    """Currencies out of the suppliers' countries."""
    return core.dim_exchange_rate(view(spark, sf, "fx"))


CUSTOMER_VERSIONS = """SELECT coalesce(user_id_db, device_id) AS customer_natural_key, email_address, max(user_id_db) AS user_id_db, max(device_id) AS device_id,
  min(CAST(event_date AS TIMESTAMP) + to_seconds(second_of_day)) AS first_seen FROM checkout GROUP BY 1, 2"""
DIM_CUSTOMER = """SELECT row_number() OVER (ORDER BY customer_natural_key, first_seen, email_address NULLS FIRST) AS customer_key, customer_natural_key,
  lead(first_seen) OVER (PARTITION BY customer_natural_key ORDER BY first_seen, email_address NULLS FIRST) IS NULL AS is_current FROM customer_versions"""
FACT = """SELECT row_number() OVER (ORDER BY ts, p.event_id, product_key NULLS FIRST, p.product_id) AS sales_line_key, event_date,
  CAST(strftime(event_date, '%Y%m%d') AS BIGINT) AS date_key, coalesce(product_key, -1) AS product_key, coalesce(customer_key, -1) AS customer_key,
  coalesce(location_key, -1) AS location_key, coalesce(device_key, -1) AS device_key, coalesce(exchange_rate_key, -1) AS exchange_rate_key,
  p.event_id, order_id, store_id, c.ip_address, p.quantity, p.cents, p.rate, p.symbol, p.code, is_recommendation_influenced, ts
FROM picked p JOIN {agents} c USING (event_id)
LEFT JOIN stg_ip g ON c.ip_address = g.ip_address
LEFT JOIN dim_product dp ON p.product_id = dp.product_id
LEFT JOIN dim_customer dc ON coalesce(c.user_id_db, c.device_id) = dc.customer_natural_key AND dc.is_current
LEFT JOIN dim_location dl ON g.country_name = dl.country_name AND coalesce(g.region_name, '') = coalesce(dl.region_name, '')
  AND coalesce(g.city_name, '') = coalesce(dl.city_name, '')
LEFT JOIN dim_device dd ON c.device_category = dd.device_category AND c.browser_name = dd.browser_name AND c.operating_system = dd.operating_system
LEFT JOIN dim_fx df ON p.code = df.currency_code"""
AGENTS = f"""(SELECT DISTINCT event_id, event_date, CAST(event_date AS TIMESTAMP) + to_seconds(second_of_day) AS ts, order_id, store_id, user_id_db, device_id,
  ip_address, is_recommendation_influenced, {AGENT} FROM checkout)"""
FACT_CTES = {
    "items": ITEMS,
    "picked": PICKED,
    "stg_ip": STG_IP,
    "stg_products": STG_PRODUCTS,
    "dim_product": DIM_PRODUCT,
    "customer_versions": CUSTOMER_VERSIONS,
    "dim_customer": DIM_CUSTOMER,
    "dim_location": DIM_LOCATION,
    "dim_device": DIM_DEVICE.format(source="checkout"),
    "dim_fx": DIM_FX,
    "fact": FACT.format(agents=AGENTS),
}
FACT_VIEWS = ("checkout", "fx", "geo", "prod_dup")


def star(spark, sf):
    """All dimensions, stored as the warehouse stores them, and the fact, from the staged stand-ins."""
    staged = distinct_checkouts(spark, sf)
    done = intermediate.checkout_success(staged)
    places = _places(spark, sf)
    rates = view(spark, sf, "fx")
    dims = {
        "dim_date": core.dim_date(spark, "1992-01-01", "2030-12-31"),
        "dim_product": packed(core.dim_product(staging.stg_products(raw_products(spark, sf, "prod_dup")))),
        "dim_customer": packed(core.dim_customer(staged)),
        "dim_location": packed(core.dim_location(places)),
        "dim_device": packed(core.dim_device(done)),
        "dim_exchange_rate": packed(core.dim_exchange_rate(rates)),
    }
    fact = core.fact_sales_order_line(intermediate.cart_items(done, places, rates, unique_events=True), **dims)
    return fact, dims


@query(
    "fact_sales_order_line",
    duck(
        """SELECT CAST(sales_line_key AS BIGINT) AS sales_line_key, event_date, date_key, CAST(product_key AS BIGINT) AS product_key,
          CAST(customer_key AS BIGINT) AS customer_key, CAST(location_key AS BIGINT) AS location_key, CAST(device_key AS BIGINT) AS device_key,
          CAST(exchange_rate_key AS BIGINT) AS exchange_rate_key, event_id, order_id, store_id, ip_address, CAST(quantity AS BIGINT) AS quantity,
          CAST(cents AS DOUBLE) / 100 AS unit_price, symbol AS transaction_currency_symbol, code AS transaction_currency_code,
          CAST(quantity * cents AS DOUBLE) / 100 AS line_total,
          CAST(quantity * cents * CAST(rate * 100 AS BIGINT) AS DOUBLE) / 10000 AS line_total_usd, is_recommendation_influenced,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_timestamp FROM fact""",
        *FACT_VIEWS,
        **FACT_CTES,
    ),
)
def fact_sales_order_line(spark, sf):
    """The complete chain: staging, cart lines, six dimensions, fact."""
    return star(spark, sf)[0]


@query("check_unique", duck("SELECT _id, CAST(count(*) AS BIGINT) AS n_records FROM ev_dup GROUP BY 1 HAVING count(*) > 1", "ev_dup"))
def check_unique(spark, sf):
    return checks.duplicated_values(view(spark, sf, "ev_dup"), "_id")


@query("having_duplicates", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def having_duplicates(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1)


@query("check_not_null", duck("SELECT _id, collection FROM ev WHERE product_id IS NULL", "ev"))
def check_not_null(spark, sf):
    return checks.null_rows(view(spark, sf, "ev").select("_id", "collection", "product_id"), "product_id").drop("product_id")


@query(
    "check_accepted_values",
    duck("SELECT status, CAST(count(*) AS BIGINT) AS n_records FROM prod WHERE status NOT IN ('success') GROUP BY 1", "prod"),
)
def check_accepted_values(spark, sf):
    return checks.unexpected_values(view(spark, sf, "prod"), "status", ["success"])


@query(
    "check_relationships",
    duck(
        """SELECT product_id, CAST(count(*) AS BIGINT) AS n_records FROM (SELECT CAST(l_partkey + CASE WHEN l_linenumber = 7 THEN 1000000000 ELSE 0 END AS VARCHAR) AS product_id FROM lineitem)
        WHERE product_id NOT IN (SELECT product_id FROM prod WHERE status = 'success') GROUP BY 1""",
        "prod",
    ),
)
def check_relationships(spark, sf):
    """Sold products that have no successful catalogue row."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 1000000000).otherwise(0)).cast("string").alias("product_id")
    )
    known = view(spark, sf, "prod").where(F.col("status") == "success")
    return checks.orphans(lines, "product_id", known, "product_id")


@query(
    "run_all_checks",
    duck(
        """SELECT 'unique event' AS check_name, CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed FROM (SELECT _id FROM ev GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique delivery', CAST(count(*) AS BIGINT), count(*) = 0 FROM (SELECT _id FROM ev_dup GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'event has product', CAST(count(*) AS BIGINT), count(*) = 0 FROM ev WHERE product_id IS NULL
        UNION ALL SELECT 'crawl status', CAST(count(DISTINCT status) AS BIGINT), count(*) = 0 FROM prod WHERE status NOT IN ('success', 'error', 'no_react_data')""",
        "ev_dup",
        "prod",
    ),
)
def run_all_checks(spark, sf):
    """A test suite in one result."""
    ev, dup = view(spark, sf, "ev"), view(spark, sf, "ev_dup")
    return checks.run_checks(
        {
            "unique event": checks.duplicated_values(ev, "_id"),
            "unique delivery": checks.duplicated_values(dup, "_id"),
            "event has product": checks.null_rows(ev, "product_id"),
            "crawl status": checks.unexpected_values(view(spark, sf, "prod"), "status", ["success", "error", "no_react_data"]),
        }
    )
