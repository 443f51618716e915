"""Dashboard tiles on the marts, and event reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.marts import (
    CUSTOMER_CTES, DAILY, GEOGRAPHY, PRODUCT, PRODUCT_CTES, customer_frame, daily_frame, geography_frame, mart_duck,
    mean_of_cents, product_frame,
)
from orderloom.catalog.profiles import _pct
from orderloom.catalog.registry import query
from orderloom.catalog.standins import duck, view
from orderloom.plans import reports as r
from orderloom.session import stored

SUMMARY = "SELECT * FROM summary JOIN top_device USING (customer_key) JOIN top_country USING (customer_key)"


def _daily(body: str) -> str:
    return mart_duck(body, daily=DAILY)


def _places(body: str) -> str:
    return mart_duck(body, places=GEOGRAPHY)


def _products(body: str) -> str:
    return mart_duck(body, "prod", **PRODUCT_CTES, products=PRODUCT)


def _customers(body: str) -> str:
    return mart_duck(body, **CUSTOMER_CTES, customers=SUMMARY)


# Money is added up in cents, so that both engines add whole numbers.
def _money(column: str = "revenue_usd") -> str:
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100"


CENTS = "sum(CAST(round(revenue_usd * 100) AS BIGINT))"


def _sum(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {column}"


@query(
    "bi_scorecard",
    _daily(
        f"""SELECT {_money()} AS revenue_usd, CAST(sum(order_count) AS BIGINT) AS orders,
          {mean_of_cents(CENTS, 'sum(order_count)')} AS avg_order_value, min(order_date) AS first_date, max(order_date) AS last_date FROM daily"""
    ),
)
def bi_scorecard(spark, sf):
    return r.scorecard(daily_frame(spark, sf)).withColumn("avg_order_value", F.round("avg_order_value", 3))


@query(
    "bi_revenue_trend",
    mart_duck(
        f"""SELECT order_date, revenue_usd, (SELECT {mean_of_cents(CENTS, 'count(*)')} FROM days) AS average_revenue_usd FROM days""",
        daily=DAILY,
        days=f"SELECT order_date, {_money()} AS revenue_usd FROM daily GROUP BY 1",
    ),
)
def bi_revenue_trend(spark, sf):
    trend = r.revenue_trend(stored(daily_frame(spark, sf)))
    return trend.withColumn("average_revenue_usd", F.round("average_revenue_usd", 3))


@query(
    "bi_top_by_revenue",
    mart_duck(
        f"""(SELECT 'store' AS board, CAST(store_id AS VARCHAR) AS item, {_money()} AS revenue_usd FROM daily GROUP BY store_id ORDER BY 3 DESC, store_id LIMIT 10)
        UNION ALL (SELECT 'product', product_id, {_money()} FROM products GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
        UNION ALL (SELECT 'collection', collection_name, {_money()} FROM products GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""",
        "prod",
        **PRODUCT_CTES,
        daily=DAILY,
        products=PRODUCT,
    ),
)
def bi_top_by_revenue(spark, sf):
    """Best stores, products and collections."""
    products = stored(product_frame(spark, sf))
    boards = {
        "store": (daily_frame(spark, sf), "store_id"), "product": (products, "product_id"),
        "collection": (products, "collection_name"),
    }
    out = None
    for board, (mart, by) in boards.items():
        top = r.top_by_revenue(mart, by, 10)
        top = top.select(F.lit(board).alias("board"), F.col(by).cast("string").alias("item"), "revenue_usd")
        out = top if out is None else out.unionByName(top)
    return out


@query(
    "bi_split_share",
    mart_duck(
        f"""SELECT 'mobile' AS split, CAST(is_mobile AS VARCHAR) AS value, {_money()} AS revenue_usd, {_sum('line_item_count')} FROM daily GROUP BY 2
        UNION ALL SELECT 'gender', gender, {_money()}, {_sum('line_item_count')} FROM products GROUP BY 2""",
        "prod",
        **PRODUCT_CTES,
        daily=DAILY,
        products=PRODUCT,
    ),
)
def bi_split_share(spark, sf):
    """Mobile against desktop, and the genders of the products."""
    mobile = r.split_revenue(daily_frame(spark, sf), "is_mobile")
    gender = r.split_revenue(product_frame(spark, sf), "gender")
    one = mobile.select(F.lit("mobile").alias("split"), F.col("is_mobile").cast("string").alias("value"), "revenue_usd", "line_item_count")
    return one.unionByName(gender.select(F.lit("gender").alias("split"), F.col("gender").alias("value"), "revenue_usd", "line_item_count"))


@query(
    "bi_guest_split",
    _daily(f"SELECT {_sum('guest_orders')}, {_sum('registered_orders')}, {_pct('sum(guest_orders)', '(sum(guest_orders) + sum(registered_orders))')} AS guest_pct FROM daily"),
)
def bi_guest_split(spark, sf):
    return r.guest_split(daily_frame(spark, sf))


@query(
    "bi_day_of_week",
    _daily(
        f"""SELECT 'weekday' AS view, day_name AS bucket, {_money()} AS revenue_usd, {_sum('order_count')} FROM daily GROUP BY 2
        UNION ALL SELECT 'week', CAST(year AS VARCHAR) || '-' || CAST(week_of_year AS VARCHAR), {_money()}, {_sum('order_count')} FROM daily GROUP BY 2"""
    ),
)
def bi_day_of_week(spark, sf):
    """Totals per weekday and per calendar week."""
    daily = stored(daily_frame(spark, sf))
    days = r.by_weekday(daily).select(F.lit("weekday").alias("view"), F.col("day_name").alias("bucket"), "revenue_usd", "order_count")
    week = F.concat(F.col("year").cast("string"), F.lit("-"), F.col("week_of_year").cast("string"))
    return days.unionByName(r.by_week(daily).select(F.lit("week").alias("view"), week.alias("bucket"), "revenue_usd", "order_count"))


@query(
    "bi_price_buckets",
    _products(
        f"""SELECT CASE WHEN avg_unit_price < 100 THEN 'below 100' WHEN avg_unit_price < 250 THEN '100 to 250' WHEN avg_unit_price < 500 THEN '250 to 500'
          WHEN avg_unit_price < 1000 THEN '500 to 1000' WHEN avg_unit_price < 2500 THEN '1000 to 2500' ELSE '2500 and more' END AS price_bucket,
          {_sum('units_sold')}, {_money()} AS revenue_usd FROM products GROUP BY 1"""
    ),
)
def bi_price_buckets(spark, sf):
    return r.units_by_price_bucket(product_frame(spark, sf))


@query("bi_type_trend", _products(f"SELECT year, month, product_type, {_money()} AS revenue_usd FROM products GROUP BY ALL"))
def bi_type_trend(spark, sf):
    return r.type_trend(product_frame(spark, sf))


@query(
    "bi_category_breakdown",
    _products(
        f"""SELECT category_name, CAST(count(DISTINCT product_id) AS BIGINT) AS products, {_sum('order_count')}, {_sum('units_sold')}, {_money()} AS revenue_usd
        FROM products GROUP BY 1"""
    ),
)
def bi_category_breakdown(spark, sf):
    return r.category_breakdown(product_frame(spark, sf))


@query(
    "bi_price_vs_revenue",
    _products(
        f"""SELECT 'price' AS chart, product_id, catalog_price AS measure, {_money()} AS revenue_usd FROM products GROUP BY ALL
        UNION ALL SELECT 'gold_weight', product_id, gold_weight, {_money()} FROM products GROUP BY ALL"""
    ),
)
def bi_price_vs_revenue(spark, sf):
    """Points of the two scatter charts."""
    products = stored(product_frame(spark, sf))
    price = r.measure_vs_revenue(products, "catalog_price").select(F.lit("price").alias("chart"), "product_id", F.col("catalog_price").alias("measure"), "revenue_usd")
    gold = r.measure_vs_revenue(products, "gold_weight").select(F.lit("gold_weight").alias("chart"), "product_id", F.col("gold_weight").alias("measure"), "revenue_usd")
    return price.unionByName(gold)


@query("bi_by_country", _places(f"SELECT country_name, {_money()} AS revenue_usd, {_sum('order_count')} FROM places GROUP BY 1"))
def bi_by_country(spark, sf):
    return r.by_country(geography_frame(spark, sf))


@query(
    "bi_customer_scorecard",
    _customers(
        f"""SELECT CAST(count(*) AS BIGINT) AS customers, {mean_of_cents(CENTS.replace('revenue', 'total_revenue'), 'count(*)')} AS avg_lifetime_value,
          {mean_of_cents('sum(days_since_last_order) * 100', 'count(*)')} AS avg_days_since_last_order, CAST(count(*) FILTER (is_guest) AS BIGINT) AS guests,
          CAST(count(*) FILTER (total_orders > 1) AS BIGINT) AS repeat_customers, {_pct('count(*) FILTER (total_orders > 1)')} AS repeat_rate_pct FROM customers"""
    ),
)
def bi_customer_scorecard(spark, sf):
    card = r.customer_scorecard(customer_frame(spark, sf))
    rounded = {n: F.round(n, 3) for n in ("avg_lifetime_value", "avg_days_since_last_order")}
    return card.withColumns(rounded)


@query(
    "bi_customer_lifecycle",
    _customers(
        f"""SELECT 'segment' AS view, purchase_frequency_segment AS bucket, CAST(count(*) AS BIGINT) AS customers FROM customers GROUP BY 2
        UNION ALL SELECT 'acquisition', strftime(date_trunc('month', first_order_date), '%Y-%m-%d'), CAST(count(*) AS BIGINT) FROM customers GROUP BY 2"""
    ),
)
def bi_customer_lifecycle(spark, sf):
    """Customers per segment and per month of first order."""
    c = stored(customer_frame(spark, sf))
    segments = r.customer_lifecycle(c).select(F.lit("segment").alias("view"), F.col("purchase_frequency_segment").alias("bucket"), "customers")
    months = r.acquisition_trend(c).select(
        F.lit("acquisition").alias("view"), F.date_format("month_start", "yyyy-MM-dd").alias("bucket"), F.col("new_customers").alias("customers")
    )
    return segments.unionByName(months)


@query("bi_top_customers", _customers("SELECT customer_key, total_orders, total_revenue_usd, purchase_frequency_segment FROM customers ORDER BY total_revenue_usd DESC, customer_key LIMIT 20"))
def bi_top_customers(spark, sf):
    return r.top_customers(customer_frame(spark, sf), 20)


@query(
    "bi_customer_preferences",
    _customers(
        " UNION ALL ".join(
            f"SELECT '{n}' AS view, {c} AS bucket, CAST(count(*) AS BIGINT) AS customers FROM customers GROUP BY 2"
            for n, c in (("device", "primary_device_category"), ("domain", "email_domain"), ("country", "primary_country"))
        )
    ),
)
def bi_customer_preferences(spark, sf):
    """Customers by preferred device, mail domain and country."""
    c = stored(customer_frame(spark, sf))
    out = None
    for name, column in (("device", "primary_device_category"), ("domain", "email_domain"), ("country", "primary_country")):
        one = r.customer_counts(c, column).select(F.lit(name).alias("view"), F.col(column).alias("bucket"), "customers")
        out = one if out is None else out.unionByName(one)
    return out


STAGE = "CASE " + " ".join(f"WHEN collection IN ({', '.join(repr(t) for t in types)}) THEN '{stage}'" for stage, types in r.LIFECYCLE.items()) + " END"


@query(
    "event_lifecycle_summary",
    duck(f"SELECT {STAGE} AS stage, CAST(count(*) AS BIGINT) AS events, {_pct('count(*)', '(SELECT count(*) FROM ev)')} AS percentage FROM ev GROUP BY 1", "ev"),
)
def event_lifecycle_summary(spark, sf):
    return r.lifecycle_summary(view(spark, sf, "ev"))


def _rate(name: str, condition: str) -> str:
    hits = f"count(*) FILTER ({condition})"
    return f"CAST({hits} AS BIGINT) AS {name}, {_pct(hits, digits=4)} AS {name}_pct"


@query(
    "conversion_rates",
    duck(
        f"""SELECT CAST(count(*) AS BIGINT) AS events, {_rate('checkout', "collection = 'checkout'")}, {_rate('checkout_success', "collection = 'checkout_success'")},
          {_rate('recommendation_visible', "collection LIKE '%recommendation_visible'")}, {_rate('recommendation_noticed', "collection LIKE '%recommendation_noticed'")},
          {_rate('recommendation_clicked', "collection LIKE '%recommendation_clicked' OR collection = 'product_view_all_recommend_clicked'")} FROM ev""",
        "ev",
    ),
)
def conversion_rates(spark, sf):
    return r.conversion_rates(view(spark, sf, "ev"))
