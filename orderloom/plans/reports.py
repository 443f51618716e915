"""Dashboard tiles over the marts, and event reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.cleaning import percent

# Stage of each event type in the visit.
LIFECYCLE = {
    "Browsing": (
        "view_listing_page", "view_static_page", "view_landing_page", "view_home_page", "view_my_account",
        "view_sorting_relevance",
    ),
    "Product": (
        "view_product_detail", "select_product_option", "select_product_option_quality", "view_shopping_cart",
        "add_to_cart_action", "product_detail_recommendation_clicked", "listing_page_recommendation_clicked",
        "landing_page_recommendation_clicked", "product_view_all_recommend_clicked",
    ),
    "Recommendation": (
        "product_detail_recommendation_visible", "listing_page_recommendation_visible",
        "product_detail_recommendation_noticed", "landing_page_recommendation_visible",
        "landing_page_recommendation_noticed", "listing_page_recommendation_noticed", "view_all_recommend",
    ),
    "Search": ("search_box_action", "sorting_relevance_click_action", "back_to_product_action"),
    "Transaction": ("checkout", "checkout_success"),
}

# Dashboard buckets for the price of a unit, in US dollars.
PRICE_BUCKETS = (100, 250, 500, 1000, 2500)


def scorecard(daily: DataFrame) -> DataFrame:
    """Revenue, orders, average order value and date range in one row."""
    return daily.agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        F.sum("order_count").alias("orders"),
        F.try_divide(F.sum("revenue_usd"), F.sum("order_count")).alias("avg_order_value"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Revenue per day next to the average over all days."""
    days = daily.groupBy("order_date").agg(F.sum("revenue_usd").alias("revenue_usd"))
    return days.withColumn("average_revenue_usd", days.agg(F.avg("revenue_usd").alias("a")).scalar())


def top_by_revenue(mart: DataFrame, by: str, size: int) -> DataFrame:
    totals = mart.groupBy(by).agg(F.sum("revenue_usd").alias("revenue_usd"))
    return totals.orderBy(F.col("revenue_usd").desc(), by).limit(size)


def share_of_total(df: DataFrame, by: Sequence[str], digits: int = 2, alias: str = "n") -> DataFrame:
    """Rows per group and their percentage of all rows. The total is a scalar subquery, not a global window."""
    groups = df.groupBy(*by).agg(F.count("*").alias(alias))
    total = groups.agg(F.sum(alias).alias("t")).scalar()
    return groups.withColumn("percentage", percent(F.col(alias), total, digits))


def split_revenue(mart: DataFrame, by: str) -> DataFrame:
    """Revenue and lines per value of a two- or three-way split."""
    return mart.groupBy(by).agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        F.sum("line_item_count").alias("line_item_count"),
        F.sum("order_count").alias("order_count"),
    )


def guest_split(daily: DataFrame) -> DataFrame:
    """Guest and registered lines, and the guest share."""
    guests, registered = F.sum("guest_orders"), F.sum("registered_orders")
    return daily.agg(
        guests.alias("guest_orders"),
        registered.alias("registered_orders"),
        percent(guests, guests + registered).alias("guest_pct"),
    )


def by_weekday(daily: DataFrame) -> DataFrame:
    return daily.groupBy("day_of_week", "day_name", "is_weekend").agg(
        F.sum("revenue_usd").alias("revenue_usd"), F.sum("order_count").alias("order_count")
    )


def by_week(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year", "week_of_year").agg(
        F.sum("revenue_usd").alias("revenue_usd"), F.sum("order_count").alias("order_count")
    )


def price_bucket(price: Column | str, bounds: Sequence[int] = PRICE_BUCKETS) -> Column:
    """Label of the half-open bucket a price falls into."""
    p = F.col(price) if isinstance(price, str) else price
    labels = F.when(p < bounds[0], f"below {bounds[0]}")
    for low, high in zip(bounds, bounds[1:]):
        labels = labels.when(p < high, f"{low} to {high}")
    return labels.when(p >= bounds[-1], f"{bounds[-1]} and more")


def units_by_price_bucket(products: DataFrame) -> DataFrame:
    rows = products.groupBy(price_bucket("avg_unit_price").alias("price_bucket"))
    return rows.agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue_usd").alias("revenue_usd"))


def type_trend(products: DataFrame) -> DataFrame:
    """Revenue per month and product type."""
    return products.groupBy("year", "month", "product_type").agg(F.sum("revenue_usd").alias("revenue_usd"))


def category_breakdown(products: DataFrame) -> DataFrame:
    return products.groupBy("category_name").agg(
        F.count_distinct("product_id").alias("products"),
        F.sum("order_count").alias("order_count"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue_usd").alias("revenue_usd"),
    )


def measure_vs_revenue(products: DataFrame, measure: str) -> DataFrame:
    """Scatter points: a catalogue measure of each product against its revenue."""
    return products.groupBy("product_id", measure).agg(F.sum("revenue_usd").alias("revenue_usd"))


def by_country(places: DataFrame) -> DataFrame:
    return places.groupBy("country_name").agg(
        F.sum("revenue_usd").alias("revenue_usd"), F.sum("order_count").alias("order_count")
    )


def customer_scorecard(customers: DataFrame) -> DataFrame:
    """Customers, lifetime value, recency, and the share that ordered more than once."""
    repeat = F.count_if(F.col("total_orders") > 1)
    return customers.agg(
        F.count("*").alias("customers"),
        F.avg("total_revenue_usd").alias("avg_lifetime_value"),
        F.avg("days_since_last_order").alias("avg_days_since_last_order"),
        F.count_if(F.col("is_guest")).alias("guests"),
        repeat.alias("repeat_customers"),
        percent(repeat, F.count("*")).alias("repeat_rate_pct"),
    )


def customer_lifecycle(customers: DataFrame) -> DataFrame:
    return customers.groupBy("purchase_frequency_segment").agg(
        F.count("*").alias("customers"), F.sum("total_revenue_usd").alias("revenue_usd")
    )


def acquisition_trend(customers: DataFrame) -> DataFrame:
    """New customers per month of first order."""
    return customers.groupBy(F.trunc("first_order_date", "month").alias("month_start")).agg(
        F.count("*").alias("new_customers")
    )


def top_customers(customers: DataFrame, size: int) -> DataFrame:
    ranked = customers.orderBy(F.col("total_revenue_usd").desc(), "customer_key").limit(size)
    return ranked.select("customer_key", "total_orders", "total_revenue_usd", "purchase_frequency_segment")


def customer_counts(customers: DataFrame, by: str) -> DataFrame:
    return customers.groupBy(by).agg(F.count("*").alias("customers"))


def lifecycle_stage(event_type: Column | str) -> Column:
    t = F.col(event_type) if isinstance(event_type, str) else event_type
    stage = None
    for name, types in LIFECYCLE.items():
        stage = F.when(t.isin(*types), name) if stage is None else stage.when(t.isin(*types), name)
    return stage


def lifecycle_summary(events: DataFrame, event_type: str = "collection") -> DataFrame:
    """Events and share per stage of the visit."""
    staged = events.select(lifecycle_stage(event_type).alias("stage"))
    return share_of_total(staged, ["stage"], alias="events")


def conversion_rates(events: DataFrame, event_type: str = "collection") -> DataFrame:
    """Share of checkouts and of recommendation events among all events."""
    t = F.col(event_type)

    def rate(hit: Column, name: str) -> list[Column]:
        return [F.count_if(hit).alias(name), percent(F.count_if(hit), F.count("*"), 4).alias(f"{name}_pct")]

    return events.agg(
        F.count("*").alias("events"),
        *rate(t == "checkout", "checkout"),
        *rate(t == "checkout_success", "checkout_success"),
        *rate(t.like(r"%\_recommendation\_visible"), "recommendation_visible"),
        *rate(t.like(r"%\_recommendation\_noticed"), "recommendation_noticed"),
        *rate(t.like(r"%\_recommendation\_clicked") | (t == "product_view_all_recommend_clicked"), "recommendation_clicked"),
    )
