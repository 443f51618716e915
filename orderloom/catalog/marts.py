"""Outliers, enriched sales and the four marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.frames import calendar, customers, devices, fact_lines, locations, raw_products
from orderloom.catalog.registry import query
from orderloom.catalog.standins import duck, table, view
from orderloom.functions.cleaning import email_domain
from orderloom.operators.dedup import top_value_per_key
from orderloom.operators.quantiles import exact_quantiles
from orderloom.operators import profiling
from orderloom.plans import intermediate, marts, quality, staging

ORDERS_AGG = """SELECT order_id, sum(quantity) AS total_quantity, sum(usd_cents) AS cents, count(*) AS line_item_count, max(quantity) AS max_quantity,
  max(usd_cents) AS max_cents, avg(unit_cents) AS avg_price FROM sales GROUP BY 1"""
LIMITS = "SELECT quantile_disc(quantity, 0.99) AS q, quantile_disc(usd_cents, 0.99) AS v FROM sales"
FLAGS = """SELECT order_id, CAST(total_quantity AS BIGINT) AS total_quantity, CAST(cents AS DOUBLE) / 100 AS total_order_value_usd,
  CAST(max_quantity AS BIGINT) AS max_line_quantity, CAST(max_cents AS DOUBLE) / 100 AS max_line_value_usd,
  max_quantity IN (9999, 999, 9998, 1000) AS is_placeholder_quantity, max_quantity > (SELECT q FROM limits) AS is_high_quantity_outlier,
  cents > (SELECT v FROM limits) AS is_high_value_outlier, line_item_count > 1 AND avg_price = 0 AS is_suspicious_pattern,
  max_quantity IN (9999, 999, 9998, 1000) OR max_quantity > (SELECT q FROM limits) OR cents > (SELECT v FROM limits) AS is_outlier FROM orders_agg"""
FLAG_CTES = {"orders_agg": ORDERS_AGG, "limits": LIMITS, "flags": FLAGS}


def mean_of_cents(cents: str, n: str) -> str:
    """Money per unit to three digits, rounded half up in whole numbers."""
    return f"CAST(({cents} * 20 + {n}) // ({n} * 2) AS DOUBLE) / 1000"


def _duck(body: str, *names: str, **ctes: str) -> str:
    return duck(body, "sales", *names, **FLAG_CTES, **ctes)


@query(
    "order_aggregates",
    duck(
        f"""SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(usd_cents) AS DOUBLE) / 100 AS total_order_value_usd,
          CAST(count(*) AS BIGINT) AS line_item_count, CAST(max(quantity) AS BIGINT) AS max_line_quantity,
          CAST(max(usd_cents) AS DOUBLE) / 100 AS max_line_value_usd, {mean_of_cents('sum(unit_cents)', 'count(*)')} AS avg_unit_price
        FROM sales GROUP BY 1""",
        "sales",
    ),
)
def order_aggregates(spark, sf):
    agg = quality.order_aggregates(fact_lines(spark, sf))
    return agg.withColumn("avg_unit_price", F.round("avg_unit_price", 3))


@query(
    "approx_quantiles",
    duck(
        """SELECT 'quantity' AS measure, p AS probability, CAST(v AS BIGINT) AS value FROM (SELECT unnest([0.25, 0.5, 0.75, 0.95, 0.99]) AS p,
          unnest(quantile_disc(quantity, [0.25, 0.5, 0.75, 0.95, 0.99])) AS v FROM sales)
        UNION ALL SELECT 'usd_cents', p, CAST(v AS BIGINT) FROM (SELECT unnest([0.25, 0.5, 0.75, 0.95, 0.99]) AS p,
          unnest(quantile_disc(usd_cents, [0.25, 0.5, 0.75, 0.95, 0.99])) AS v FROM sales)""",
        "sales",
    ).replace("SELECT 'quantity' AS measure, p AS", "SELECT 'quantity' AS measure, CAST(p AS DOUBLE) AS").replace("'usd_cents', p,", "'usd_cents', CAST(p AS DOUBLE),"),
)
def approx_quantiles(spark, sf):
    """Exact discrete quantiles of two measures."""
    measures = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("amount")) for c in ("quantity", "usd_cents")])
    rows = view(spark, sf, "sales").select(F.explode(measures).alias("m")).select("m.*")
    found = exact_quantiles(rows, "amount", ["0.25", "0.5", "0.75", "0.95", "0.99"], ["measure"], few_groups=True)
    return found.withColumn("value", F.col("value").cast("bigint"))


@query(
    "multi_count_distinct",
    duck(
        """SELECT CAST(count(DISTINCT product_id) AS BIGINT) AS distinct_product_id, CAST(count(DISTINCT url) AS BIGINT) AS distinct_url,
          CAST(count(DISTINCT sku) AS BIGINT) AS distinct_sku, CAST(count(DISTINCT category) AS BIGINT) AS distinct_category,
          CAST(count(DISTINCT category_name) AS BIGINT) AS distinct_category_name, CAST(count(DISTINCT collection) AS BIGINT) AS distinct_collection,
          CAST(count(DISTINCT attribute_set) AS BIGINT) AS distinct_attribute_set, CAST(count(DISTINCT store_code) AS BIGINT) AS distinct_store_code,
          CAST(count(DISTINCT currency_code) AS BIGINT) AS distinct_currency_code, CAST(count(DISTINCT product_type) AS BIGINT) AS distinct_product_type,
          CAST(count(DISTINCT gender) AS BIGINT) AS distinct_gender, CAST(count(DISTINCT material_design) AS BIGINT) AS distinct_material_design FROM prod""",
        "prod",
    ),
)
def multi_count_distinct(spark, sf):
    """Distinct values of twelve columns."""
    names = [
        "product_id", "url", "sku", "category", "category_name", "collection", "attribute_set", "store_code",
        "currency_code", "product_type", "gender", "material_design",
    ]
    return profiling.cardinality(view(spark, sf, "prod"), names)


@query(
    "countif_breakdown",
    duck(
        "SELECT store_id, CAST(count(*) FILTER (quantity > 25) AS BIGINT) AS large_lines, CAST(count(*) FILTER (unit_cents = 0) AS BIGINT) AS free_lines FROM sales GROUP BY 1",
        "sales",
    ),
)
def countif_breakdown(spark, sf):
    return view(spark, sf, "sales").groupBy("store_id").agg(
        F.count_if(F.col("quantity") > 25).alias("large_lines"), F.count_if(F.col("unit_cents") == 0).alias("free_lines")
    )


@query(
    "conditional_distinct",
    duck(
        """SELECT store_id, CAST(count(DISTINCT CASE WHEN location_key > 0 THEN customer_key END) AS BIGINT) AS located_customers,
          CAST(count(DISTINCT order_id) AS BIGINT) AS orders FROM sales GROUP BY 1""",
        "sales",
    ),
)
def conditional_distinct(spark, sf):
    return view(spark, sf, "sales").groupBy("store_id").agg(
        F.count_distinct(F.when(F.col("location_key") > 0, F.col("customer_key"))).alias("located_customers"),
        F.count_distinct("order_id").alias("orders"),
    )


@query(
    "top_value_per_key",
    """SELECT l_suppkey, l_returnflag AS top_flag FROM lineitem GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) = 1""",
)
def most_common_value(spark, sf):
    return top_value_per_key(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", "top_flag")


@query(
    "string_agg_distinct",
    """SELECT store, string_agg(flag, ', ' ORDER BY flag) AS types FROM (SELECT DISTINCT l_suppkey AS store, p_brand AS flag
      FROM lineitem JOIN part ON l_partkey = p_partkey QUALIFY dense_rank() OVER (PARTITION BY l_suppkey ORDER BY p_brand) <= 5) GROUP BY 1""",
)
def string_agg_distinct(spark, sf):
    """Up to five distinct brands per supplier as one text."""
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("flag"))
    sold = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("store"), "l_partkey").join(brands, "l_partkey")
    return profiling.joined_values(sold, ["store"], "flag", "types", 5)


@query("sales_outliers", _duck("SELECT * FROM flags WHERE is_outlier"))
def sales_outliers(spark, sf):
    return quality.sales_outliers(fact_lines(spark, sf))


def _flagged(flag: str):
    def run(spark, sf):
        orders = quality.flag_orders(fact_lines(spark, sf))
        return orders.where(F.col(flag)).select("order_id", "max_line_quantity", "total_order_value_usd")

    return run


for _name, _flag in {
    "outlier_placeholder_quantity": "is_placeholder_quantity",
    "outlier_high_quantity": "is_high_quantity_outlier",
    "outlier_high_value": "is_high_value_outlier",
    "outlier_suspicious_pattern": "is_suspicious_pattern",
}.items():
    query(_name, _duck(f"SELECT order_id, max_line_quantity, total_order_value_usd FROM flags WHERE {_flag}"))(_flagged(_flag))


@query(
    "outlier_summary",
    _duck(
        """SELECT CAST(count(*) AS BIGINT) AS total_outlier_orders, CAST(sum(CAST(is_placeholder_quantity AS INT)) AS BIGINT) AS placeholder_quantity_count,
          CAST(sum(CAST(is_high_quantity_outlier AS INT)) AS BIGINT) AS high_quantity_count, CAST(sum(CAST(is_high_value_outlier AS INT)) AS BIGINT) AS high_value_count,
          CAST(sum(CAST(is_suspicious_pattern AS INT)) AS BIGINT) AS suspicious_pattern_count,
          CAST(sum(CAST(round(total_order_value_usd * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_outlier_revenue_usd,
          round(CAST(sum(CAST(round(total_order_value_usd * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100, 2) AS avg_outlier_order_value_usd,
          (SELECT CAST(count(DISTINCT order_id) AS BIGINT) FROM sales) AS total_orders_in_dataset,
          round(100.0 * count(*) / (SELECT count(DISTINCT order_id) FROM sales), 2) AS pct_of_total_orders FROM flags WHERE is_outlier"""
    ),
)
def outlier_summary(spark, sf):
    fact = fact_lines(spark, sf)
    return quality.outlier_summary(quality.sales_outliers(fact), fact)


DIM_CTES = {
    "people": """SELECT c_custkey + 1 AS customer_key, 'k' || c_custkey AS customer_natural_key, CASE WHEN c_custkey % 7 <> 0 THEN 'u' || c_custkey ||
      CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '@mail' || (c_custkey % 6) || '.com' END END AS email_address FROM customer""",
    "device": "SELECT 1 AS device_key, 'Mobile' AS device_category, TRUE AS is_mobile UNION ALL SELECT 2, 'Tablet', TRUE UNION ALL SELECT 3, 'Desktop', FALSE",
    "place": """SELECT n_nationkey + 1 AS location_key, n_name AS country_name, r_name AS region_name,
      CASE WHEN n_nationkey % 4 <> 0 THEN 'city ' || (n_nationkey % 3) END AS city_name FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown'""",
    "swc": """SELECT s.*, p.customer_natural_key, p.email_address, p.customer_key IS NOT NULL AND p.email_address IS NULL AS is_guest,
      coalesce(f.is_placeholder_quantity AND f.is_outlier, FALSE) AS is_placeholder_quantity, coalesce(f.is_high_quantity_outlier AND f.is_outlier, FALSE) AS is_high_quantity_outlier,
      coalesce(f.is_high_value_outlier AND f.is_outlier, FALSE) AS is_high_value_outlier, coalesce(f.is_suspicious_pattern AND f.is_outlier, FALSE) AS is_suspicious_pattern,
      coalesce(f.is_outlier, FALSE) AS is_outlier
      FROM sales s LEFT JOIN people p USING (customer_key) LEFT JOIN flags f USING (order_id)""",
    "normal": "SELECT * FROM swc WHERE NOT is_outlier",
}


def mart_duck(body: str, *names: str, **ctes: str) -> str:
    return _duck(body, *names, **DIM_CTES, **ctes)


def sales_frame(spark, sf):
    """Enriched sales lines of the stand-in fact."""
    fact = fact_lines(spark, sf)
    return intermediate.sales_with_customer(fact, calendar(spark), customers(spark, sf), quality.sales_outliers(fact))


@query(
    "sales_with_customer",
    mart_duck(
        """SELECT order_id, order_date, store_id, customer_key, product_key, CAST(quantity AS BIGINT) AS quantity, CAST(usd_cents AS DOUBLE) / 100 AS line_total_usd,
          customer_natural_key, email_address, is_guest, is_placeholder_quantity, is_high_quantity_outlier, is_high_value_outlier, is_suspicious_pattern, is_outlier FROM swc"""
    ),
)
def sales_with_customer(spark, sf):
    return sales_frame(spark, sf).select(
        "order_id", "order_date", "store_id", "customer_key", "product_key", "quantity", "line_total_usd",
        "customer_natural_key", "email_address", "is_guest", "is_placeholder_quantity", "is_high_quantity_outlier",
        "is_high_value_outlier", "is_suspicious_pattern", "is_outlier",
    )


DAILY = """SELECT order_date, store_id, device_category, is_mobile, CAST(year(order_date) AS BIGINT) AS year, CAST(quarter(order_date) AS BIGINT) AS quarter,
  CAST(month(order_date) AS BIGINT) AS month, CAST(strftime(order_date, '%U') AS BIGINT) AS week_of_year,
  CAST(dayofweek(order_date) + 1 AS BIGINT) AS day_of_week, strftime(order_date, '%A') AS day_name, dayofweek(order_date) IN (0, 6) AS is_weekend,
  CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, CAST(count(*) AS BIGINT) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
  CAST(sum(usd_cents) AS DOUBLE) / 100 AS revenue_usd, CAST(count(DISTINCT customer_key) AS BIGINT) AS unique_customers,
  CAST(count(*) FILTER (is_guest) AS BIGINT) AS guest_orders, CAST(count(*) FILTER (NOT is_guest) AS BIGINT) AS registered_orders
FROM normal JOIN device USING (device_key) GROUP BY ALL"""


def daily_frame(spark, sf):
    return marts.mart_sales_daily(sales_frame(spark, sf), devices(spark, sf), calendar(spark))


query("mart_sales_daily", mart_duck(DAILY))(daily_frame)

GEOGRAPHY = """SELECT order_date, country_name, region_name, city_name, CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
  CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, CAST(count(*) AS BIGINT) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
  CAST(sum(usd_cents) AS DOUBLE) / 100 AS revenue_usd, CAST(count(DISTINCT customer_key) AS BIGINT) AS unique_customers
FROM normal JOIN place USING (location_key) WHERE city_name IS NOT NULL GROUP BY ALL"""


def geography_frame(spark, sf):
    return marts.mart_sales_by_geography(sales_frame(spark, sf), locations(spark, sf), calendar(spark))


query("mart_sales_by_geography", mart_duck(GEOGRAPHY))(geography_frame)

def products_frame(spark, sf):
    """Product dimension whose keys match the stand-in fact."""
    p = staging.stg_products(raw_products(spark, sf))
    return p.withColumn("product_key", F.col("product_id").cast("bigint") + 1).drop("status", "ingested_at")


def product_frame(spark, sf):
    return marts.mart_sales_by_product(sales_frame(spark, sf), products_frame(spark, sf), calendar(spark))


def _stg_products() -> str:
    from orderloom.catalog.cleaning import STG_PRODUCTS

    return STG_PRODUCTS.replace("FROM prod_dup", "FROM prod")


PRODUCT = f"""SELECT order_date, product_id, product_name, sku, product_type, category_id, category_name, collection_name, gender, price AS catalog_price,
  min_price AS catalog_min_price, max_price AS catalog_max_price, gold_weight, currency_code AS catalog_currency,
  CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
  CAST(count(*) AS BIGINT) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(usd_cents) AS DOUBLE) / 100 AS revenue_usd,
  {mean_of_cents('sum(unit_cents)', 'count(*)')} AS avg_unit_price, CAST(min(unit_cents) AS DOUBLE) / 100 AS min_unit_price,
  CAST(max(unit_cents) AS DOUBLE) / 100 AS max_unit_price, CAST(count(*) FILTER (NOT is_guest) AS BIGINT) AS registered_customer_orders,
  CAST(count(*) FILTER (is_guest) AS BIGINT) AS guest_orders,
  CAST(count(DISTINCT nullif(regexp_extract(email_address, '@(.+)$', 1), '')) AS BIGINT) AS unique_email_domains
FROM normal JOIN stg_products ON CAST(product_id AS BIGINT) + 1 = product_key GROUP BY ALL"""
PRODUCT_CTES = {"stg_products": _stg_products()}


@query("mart_sales_by_product", mart_duck(PRODUCT, "prod", **PRODUCT_CTES))
def mart_sales_by_product(spark, sf):
    mart = product_frame(spark, sf)
    return mart.withColumn("avg_unit_price", F.round("avg_unit_price", 3))


AS_OF = "2002-01-01"
TOP = """SELECT customer_key, {col} AS {name} FROM normal LEFT JOIN {dim} USING ({key}) GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY count(*) DESC, {col} NULLS LAST) = 1"""
CUSTOMER_CTES = {
    "top_device": TOP.format(col="device_category", name="primary_device_category", dim="device", key="device_key"),
    "top_country": TOP.format(col="country_name", name="primary_country", dim="place", key="location_key"),
    "summary": f"""SELECT customer_key, customer_natural_key, email_address, CASE WHEN email_address IS NULL THEN 'Guest'
      ELSE nullif(regexp_extract(email_address, '@(.+)$', 1), '') END AS email_domain, is_guest, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
      CAST(date_diff('day', min(order_date), max(order_date)) AS BIGINT) AS days_between_first_last,
      CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS BIGINT) AS days_since_last_order, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
      CAST(sum(usd_cents) AS DOUBLE) / 100 AS total_revenue_usd, {mean_of_cents('sum(usd_cents)', 'count(DISTINCT order_id)')} AS avg_order_value,
      CAST(sum(quantity) AS BIGINT) AS total_units_purchased, CASE WHEN count(DISTINCT order_id) = 1 THEN 'One-time'
      WHEN count(DISTINCT order_id) BETWEEN 2 AND 5 THEN 'Repeat' ELSE 'Loyal' END AS purchase_frequency_segment
      FROM normal GROUP BY customer_key, customer_natural_key, email_address, is_guest""",
}


def customer_frame(spark, sf):
    return marts.mart_customer_summary(
        sales_frame(spark, sf), devices(spark, sf), locations(spark, sf), F.lit(AS_OF).cast("date")
    )


@query(
    "mart_customer_summary",
    mart_duck("SELECT * FROM summary JOIN top_device USING (customer_key) JOIN top_country USING (customer_key)", **CUSTOMER_CTES),
)
def mart_customer_summary(spark, sf):
    mart = customer_frame(spark, sf)
    return mart.withColumn("avg_order_value", F.round("avg_order_value", 3))
