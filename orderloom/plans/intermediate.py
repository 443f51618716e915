"""Checkout events and their cart lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import agents, cleaning as c
from orderloom.operators.lookups import asked_for, fx_pick, join_in_buckets, repeated
from orderloom.session import broadcasts, dealt, packed, task_count


def checkout_success(stg_events: DataFrame) -> DataFrame:
    """Completed orders with cart and user agent, device parsed from the agent."""
    done = stg_events.where(
        (F.col("event_type") == "checkout_success")
        & F.col("order_id").isNotNull()
        & F.col("cart_products").isNotNull()
        & F.col("user_agent").isNotNull()
    )
    return done.select(
        "event_id", "event_timestamp", "event_date", "event_type", "store_id", "user_id_db", "device_id",
        "ip_address", "user_agent", "current_url", "order_id", "cart_products", "currency_code",
        "is_recommendation_influenced", "ingested_at",
        agents.device_category("user_agent").alias("device_category"),
        agents.browser_name("user_agent").alias("browser_name"),
        agents.operating_system("user_agent").alias("operating_system"),
    )


def explode_cart(checkouts: DataFrame) -> DataFrame:
    """One row per cart entry. Orders with an empty cart have none."""
    lines = checkouts.withColumn("item", F.explode("cart_products")).drop("cart_products", "user_agent")
    return lines.select(
        "event_id", "event_timestamp", "event_date", "store_id", "user_id_db", "device_id", "ip_address",
        "device_category", "browser_name", "operating_system", "order_id", "current_url",
        "is_recommendation_influenced",
        F.col("item.product_id").cast("string").alias("product_id"),
        F.col("item.amount").alias("quantity"),
        F.coalesce("item.currency", F.lit("")).alias("transaction_currency_symbol"),
        c.parse_locale_price("item.price").alias("transaction_price"),
        c.natural_key("user_id_db", "device_id").alias("customer_natural_key"),
    )


LINE_KEY = ("event_id", "product_id")


def cart_items(
    checkouts: DataFrame,
    stg_ip_locations: DataFrame,
    exchange_rates: DataFrame,
    keys: Sequence[str] = LINE_KEY,
    unique_events: bool = False,
) -> DataFrame:
    """Priced cart lines with place and currency, one per event and product.

    The rate is picked before the location join: that shuffle carries fewer columns, and a repeated
    product collapses first. Among equal priorities the smaller code, then the dearer line wins.
    With `unique_events` (staging leaves one row per event) only carts that repeat a product are shuffled for that.
    """
    tie_break = [F.col("transaction_price").desc(), F.col("quantity").desc(), "transaction_currency_symbol"]
    if unique_events and tuple(keys) == LINE_KEY:
        products = F.transform("cart_products", lambda i: i["product_id"])
        repeats = F.size(F.array_distinct(products)) < F.size(products)
        lines = fx_pick(explode_cart(checkouts.where(~repeats)), exchange_rates).unionByName(
            fx_pick(explode_cart(checkouts.where(repeats)), exchange_rates, keys, tie_break)
        )
    else:
        lines = fx_pick(explode_cart(checkouts), exchange_rates, keys, tie_break)
    places = stg_ip_locations.select("ip_address", "country_name", "region_name", "city_name")
    return lines.join(places, "ip_address", "left").select(
        "event_id", "event_timestamp", "event_date", "store_id", "user_id_db", "device_id", "ip_address",
        "country_name", "region_name", "city_name", "device_category", "browser_name",
        "operating_system", "order_id", "product_id", "quantity", "transaction_price",
        "transaction_currency_symbol", "transaction_currency_code", "transaction_rate_to_usd",
        "is_recommendation_influenced", "customer_natural_key",
    )


def sales_with_customer(
    fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, outliers: DataFrame
) -> DataFrame:
    """Fact lines with order date, current customer and outlier flags. Give a stored fact: its rows are counted first.

    Customers that are too many to broadcast come to the orders, so lines are not shuffled for them. The lines are dealt
    by order into tasks of bounded size; the flags, and the first lines of orders in a mart, need no other deal. A task
    has fewer flagged orders than lines, so they are hashed in memory and no line is sorted for them.
    """
    flags = [
        "is_placeholder_quantity", "is_high_quantity_outlier", "is_high_value_outlier",
        "is_suspicious_pattern", "is_outlier",
    ]
    lines = fact.select(
        "sales_line_key", "order_id", "store_id", "quantity", "unit_price", "line_total", "line_total_usd",
        "transaction_currency_symbol", "transaction_currency_code", "ip_address", "date_key",
        "customer_key", "product_key", "location_key", "device_key", "exchange_rate_key",
    )
    days = dim_date.select("date_key", F.col("full_date").alias("order_date"))
    people = dim_customer.where(F.col("is_current")).select(
        "customer_key", "customer_natural_key", "email_address", F.col("email_address").isNull().alias("is_guest")
    )
    dated = lines.join(days, "date_key", "left")
    n = fact.count()
    if broadcasts(people) or repeated(people, "customer_key"):
        named = dealt(dated.join(people, "customer_key", "left"), "order_id", rows=n)
    else:
        found = {"customer_key": packed(asked_for(fact, "order_id", "customer_key", people))}
        named = join_in_buckets(dated, found, "order_id", task_count(fact.sparkSession, n))
    return (
        named.join(dealt(outliers.select("order_id", *flags), "order_id", rows=n).hint("shuffle_hash"), "order_id", "left")
        .select(
            "sales_line_key", "order_id", "store_id", "quantity", "unit_price", "line_total",
            "line_total_usd", "transaction_currency_symbol", "transaction_currency_code", "ip_address",
            "date_key", "order_date", "customer_key", "customer_natural_key", "email_address", "is_guest",
            "product_key", "location_key", "device_key", "exchange_rate_key",
            *[F.coalesce(f, F.lit(False)).alias(f) for f in flags],
        )
    )
