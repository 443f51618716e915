"""Staging: one clean row per natural key of each raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import cleaning as c
from orderloom.operators.dedup import latest_per_key


def stg_events(
    raw: DataFrame,
    store_range: tuple[int, int] | None = None,
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """Latest copy of every event, typed, blanks as NULL. A store id that is no number fails the job.

    Columns are narrowed before the deduplication shuffle. `store_range` optionally drops stores
    outside the inclusive range.
    """
    narrow = raw.select(
        F.col("_id").alias("event_id"), "time_stamp", F.col("collection").alias("event_type"), "store_id",
        "user_id_db", "device_id", "email_address", F.col("ip").alias("ip_address"), "user_agent",
        "resolution", "current_url", "referrer_url", "order_id", "cart_products", "product_id",
        F.col("currency").alias("currency_code"), "price",
        F.col("recommendation").alias("is_recommendation_influenced"), "ingested_at",
    )
    if store_range is not None:
        narrow = narrow.where(F.col("store_id").try_cast("bigint").between(*store_range))
    rows = latest_per_key(narrow, ["event_id"], tie_break=tie_break)
    at = F.timestamp_seconds(F.col("time_stamp").cast("bigint"))
    blank = c.blank_to_null
    unknown = F.lit(None).cast("string")
    return rows.select(
        "event_id",
        at.alias("event_timestamp"),
        F.to_date(at).alias("event_date"),
        blank("event_type").alias("event_type"),
        F.col("store_id").cast("bigint").alias("store_id"),
        *[
            blank(name).alias(name)
            for name in (
                "user_id_db", "device_id", "email_address", "ip_address", "user_agent", "resolution",
                "current_url", "referrer_url", "order_id",
            )
        ],
        "cart_products",
        blank("product_id").alias("product_id"),
        blank("currency_code").alias("currency_code"),
        c.safe_decimal("price").alias("price"),
        "is_recommendation_influenced",
        "ingested_at",
        unknown.alias("device_category"),
        unknown.alias("browser_name"),
        unknown.alias("operating_system"),
    )


def stg_ip_locations(raw: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Latest location per address with its completeness level."""
    rows = latest_per_key(raw, ["ip"], tie_break=tie_break)
    return rows.select(
        F.col("ip").alias("ip_address"),
        c.blank_to_null("country").alias("country_name"),
        c.blank_to_null("region").alias("region_name"),
        c.blank_to_null("city").alias("city_name"),
        "ingested_at",
    ).withColumn("geo_completeness_level", c.geo_completeness("country_name", "region_name", "city_name"))


def stg_products(raw: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Latest successful crawl per product; sentinels and impossible prices removed."""
    narrow = raw.where(F.col("status") == "success").select(
        "product_id", "url", "product_name", "sku", "product_type", "collection", "gender", "category",
        "category_name", "currency_code", "price", "min_price", "max_price", "gold_weight", "status",
        "ingested_at",
    )
    rows = latest_per_key(narrow, ["product_id"], tie_break=tie_break)
    blank, amount = c.blank_to_null, c.safe_decimal
    return rows.select(
        "product_id",
        blank("url").alias("url"),
        blank("product_name").alias("product_name"),
        blank("sku").alias("sku"),
        c.sentinel_to_unknown("product_type", c.PRODUCT_TYPE_SENTINELS).alias("product_type"),
        blank("collection").alias("collection_name"),
        c.sentinel_to_unknown("gender", c.GENDER_SENTINELS).alias("gender"),
        c.zero_code_to_null("category").alias("category_id"),
        c.sentinel_to_unknown("category_name").alias("category_name"),
        blank("currency_code").alias("currency_code"),
        *[c.positive_or_null(amount(p)).alias(p) for p in ("price", "min_price", "max_price")],
        amount("gold_weight").alias("gold_weight"),
        "status",
        "ingested_at",
    )
