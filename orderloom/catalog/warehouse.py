"""The warehouse built as stored models, and loaded again."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog import history as hist, marts as m
from orderloom.catalog.frames import calendar, devices, distinct_checkouts, locations, raw_products
from orderloom.catalog.registry import query, scratch
from orderloom.catalog.standins import duck, view
from orderloom.catalog.star import CUSTOMER_VERSIONS, FACT_CTES, FACT_VIEWS, _places
from orderloom.plans.warehouse import Model, build_models
from orderloom.session import stored
from orderloom.sources import published

# Amounts in hundredths of a cent: cents times a rate of two digits.
BUILT = {
    "people": f"""SELECT row_number() OVER (ORDER BY customer_natural_key, first_seen, email_address NULLS FIRST) AS customer_key, email_address,
      lead(first_seen) OVER (PARTITION BY customer_natural_key ORDER BY first_seen, email_address NULLS FIRST) IS NULL AS is_current FROM ({CUSTOMER_VERSIONS})""",
    "amounts": "SELECT *, quantity * cents * CAST(rate * 100 AS BIGINT) AS usd FROM fact",
    "limits": "SELECT quantile_disc(quantity, 0.99) AS q, quantile_disc(usd, 0.99) AS v FROM amounts",
    "odd": """SELECT order_id FROM amounts GROUP BY 1 HAVING max(quantity) IN (9999, 999, 9998, 1000) OR max(quantity) > (SELECT q FROM limits)
      OR sum(usd) > (SELECT v FROM limits)""",
}


def _sources(spark, sf):
    days = spark.range(1).select(F.explode(F.expr("sequence(date'1992-01-01', date'2030-12-31')")).alias("date_day"))
    return {
        "stg_events": distinct_checkouts(spark, sf), "stg_ip_locations": _places(spark, sf), "raw_products": raw_products(spark, sf, "prod_dup"),
        "exchange_rates": view(spark, sf, "fx"), "days": days,
    }


@query(
    "build_models",
    duck(
        """SELECT event_date AS order_date, store_id, device_category, is_mobile, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
          CAST(count(*) AS BIGINT) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(usd) AS DOUBLE) / 10000 AS revenue_usd,
          CAST(count(DISTINCT a.customer_key) AS BIGINT) AS unique_customers, CAST(count(*) FILTER (email_address IS NULL) AS BIGINT) AS guest_orders,
          CAST(count(*) FILTER (email_address IS NOT NULL) AS BIGINT) AS registered_orders
        FROM amounts a JOIN dim_device USING (device_key) LEFT JOIN people p ON p.customer_key = a.customer_key AND is_current
        WHERE order_id NOT IN (SELECT order_id FROM odd) GROUP BY 1, 2, 3, 4""",
        *FACT_VIEWS,
        **FACT_CTES,
        **BUILT,
    ),
)
def built_models(spark, sf):
    """Dimensions, fact, outliers, sales and marts built into one version; the daily mart read from it."""
    root = scratch(spark)
    build_models(spark, root, _sources(spark, sf))
    mart = published.read_table(spark, root, "mart_sales_daily")
    return mart.select(
        "order_date", "store_id", "device_category", "is_mobile", "order_count", "line_item_count", "units_sold", "revenue_usd",
        "unique_customers", "guest_orders", "registered_orders",
    )


# The first load ends in May 1998. Some orders of its last days and of January arrive later; the second load reopens 20
# days, that is May, so the late orders of January stay out.
LATE = "CAST(order_id AS BIGINT) % 50 = 7 AND (order_date BETWEEN DATE '1998-05-20' AND DATE '1998-05-31' OR order_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31')"
FIRST = f"order_date < DATE '1998-06-01' AND NOT ({LATE})"
ARRIVED = {"arrived": f"SELECT * FROM normal WHERE order_date >= DATE '1998-05-01' OR NOT ({LATE})"}


# The columns of the sales that each mart reads; only these are stored between the loads.
READ = {
    "mart_sales_daily": ("store_id", "device_key", "customer_key", "is_guest"),
    "mart_sales_by_geography": ("location_key", "customer_key"),
    "mart_sales_by_product": ("product_key", "unit_price", "is_guest", "email_address"),
}


def _two_loads(spark, sf, name):
    root = scratch(spark)
    sales = stored(m.sales_frame(spark, sf).select("order_date", "order_id", "quantity", "line_total_usd", "is_outlier", *READ[name]))
    dims = {"dim_device": devices(spark, sf), "dim_location": locations(spark, sf), "dim_product": m.products_frame(spark, sf), "dim_date": calendar(spark)}
    build_models(spark, root, {**dims, "int_sales_with_customer": sales.where(FIRST)}, wanted=[name])
    build_models(spark, root, {**dims, "int_sales_with_customer": sales}, wanted=[name], lookback_days=20)
    return published.read_table(spark, root, name)


def _arrived(sql: str) -> str:
    return sql.replace("FROM normal", "FROM arrived")


@query("incremental_mart_daily", m.mart_duck(_arrived(m.DAILY), **ARRIVED))
def incremental_mart_daily(spark, sf):
    """Two loads of the daily mart; days that arrive late but inside the lookback are counted again."""
    return _two_loads(spark, sf, "mart_sales_daily")


@query("incremental_mart_geography", m.mart_duck(_arrived(m.GEOGRAPHY), **ARRIVED))
def incremental_mart_geography(spark, sf):
    return _two_loads(spark, sf, "mart_sales_by_geography")


@query("incremental_mart_product", m.mart_duck(_arrived(m.PRODUCT), "prod", **m.PRODUCT_CTES, **ARRIVED))
def incremental_mart_product(spark, sf):
    mart = _two_loads(spark, sf, "mart_sales_by_product")
    return mart.withColumn("avg_unit_price", F.round("avg_unit_price", 3))


SIGHTINGS = {"dim_customer": Model(lambda rows: rows, ("sightings",), "history", ("customer_natural_key",))}


@query(
    "history_table_upsert",
    duck(
        f"SELECT {hist.SHOW} FROM (SELECT * FROM history WHERE customer_key NOT IN (SELECT customer_key FROM delta) UNION ALL SELECT * FROM delta)",
        **hist._delta("latest"),
    ),
)
def history_table_upsert(spark, sf):
    """The customer history as a stored table: the second load replaces the buckets that change and adds closed rows."""
    root = scratch(spark)
    build_models(spark, root, {"sightings": hist._seen(spark, sf, "1996-01-01")}, SIGHTINGS)
    build_models(spark, root, {"sightings": hist._seen(spark, sf)}, SIGHTINGS, now=hist._now())
    return published.read_table(spark, root, "dim_customer")
