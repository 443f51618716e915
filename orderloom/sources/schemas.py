"""Raw table layouts. Every JSON field is read as text first and cast afterwards."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column order and types of the three raw tables.
EVENT_OPTION = (
    "array<struct<option_id:string,option_label:string,value_id:string,value_label:string,"
    "quality:string,quality_label:string>>"
)
CART_OPTION = "array<struct<option_id:bigint,option_label:string,value_id:bigint,value_label:string>>"
CART = f"array<struct<product_id:bigint,amount:bigint,price:string,currency:string,option:{CART_OPTION}>>"

EVENTS = {
    "_id": "string", "device_id": "string", "user_id_db": "string", "email_address": "string",
    "ip": "string", "store_id": "string", "user_agent": "string", "resolution": "string",
    "utm_source": "string", "utm_medium": "string", "api_version": "string", "collection": "string",
    "time_stamp": "bigint", "local_time": "string", "collect_id": "string", "current_url": "string",
    "referrer_url": "string", "show_recommendation": "string", "product_id": "string",
    "viewing_product_id": "string", "option": EVENT_OPTION, "price": "string", "currency": "string",
    "cat_id": "string", "key_search": "string", "cart_products": CART, "order_id": "string",
    "is_paypal": "boolean", "recommendation": "boolean", "recommendation_product_id": "string",
    "recommendation_product_position": "string", "recommendation_clicked_position": "bigint",
    "ingested_at": "timestamp",
}

PRODUCTS = {
    "product_id": "string", "url": "string", "status": "string", "http_status": "bigint",
    "error_message": "string", "fallback_used": "boolean", "product_name": "string", "sku": "string",
    "attribute_set_id": "bigint", "attribute_set": "string", "type_id": "string", "product_type": "string",
    "product_type_value": "string", "price": "string", "min_price": "string", "max_price": "string",
    "min_price_format": "string", "max_price_format": "string", "gold_weight": "string",
    "none_metal_weight": "double", "fixed_silver_weight": "double", "material_design": "string",
    "qty": "bigint", "collection": "string", "collection_id": "string", "category": "string",
    "category_name": "string", "store_code": "string", "gender": "string",
    "platinum_palladium_info_in_alloy": "bigint", "bracelet_without_chain": "bigint",
    "show_popup_quantity_eternity": "bigint", "visible_contents": "array<string>",
    "configure_mode": "bigint", "included_chain_weight": "double", "currency_code": "string",
    "tax_rate": "double", "primary_image_url": "string", "primary_video_url": "string",
    "gender_label": "string", "is_solid": "string", "ingested_at": "timestamp",
}

IP_LOCATIONS = {
    "ip": "string", "country": "string", "region": "string", "city": "string", "ingested_at": "timestamp",
}

TABLES = {"events": EVENTS, "products": PRODUCTS, "ip_locations": IP_LOCATIONS}
REQUIRED = {
    "events": ("_id", "collection", "ingested_at"),
    "products": ("product_id", "ingested_at"),
    "ip_locations": ("ip", "ingested_at"),
}


def missing_required(df: DataFrame, table: str) -> DataFrame:
    """Rows without a value, for each column that the raw table must have: one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED[table]])
    each = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in REQUIRED[table]])
    return counts.select(F.explode(each).alias("r")).select("r.*")


@dataclass(frozen=True)
class Source:
    """Tests of a raw table's columns, and how old its newest load may be."""

    tests: Mapping[str, tuple[str, ...]]
    loaded_at: str = "ingested_at"
    most_days: int = 2


SOURCES = {
    "events": Source({"_id": ("unique", "not_null")}),
    "ip_locations": Source({"ip": ("not_null",)}),
    "products": Source({"product_id": ("unique", "not_null")}),
}


def check_declared(df: DataFrame, table: str, now: Column | None = None, source: Source | None = None) -> DataFrame:
    """(table_name, column_name, test, failing, passed) of all declared tests: one scan and one shuffle of values.

    failing is the number of values that occur more than once (unique), of rows without a value (not_null), or of days
    that the newest load is too old (fresh; an empty table is too old by one day).
    """
    source = source or SOURCES[table]
    now = F.current_timestamp() if now is None else now
    tested = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in source.tests]
    loaded = F.struct(F.lit(source.loaded_at).alias("c"), F.lit(None).cast("string").alias("v"))
    pairs = df.select(F.col(source.loaded_at).alias("at"), F.explode(F.array(*tested, loaded)).alias("p")).select("at", "p.*")
    values = pairs.groupBy("c", "v").agg(F.count("*").alias("n"), F.max("at").alias("at"))
    per_column = values.groupBy("c").agg(
        F.count_if(F.col("v").isNotNull() & (F.col("n") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("not_null"),
        F.max("at").alias("at"),
    )
    late = F.coalesce(F.greatest(F.date_diff(now, "at") - source.most_days, F.lit(0)), F.lit(1)).cast("bigint").alias("fresh")
    declared = [(c, t) for c, tests in source.tests.items() for t in tests] + [(source.loaded_at, "fresh")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test")) for c, t in declared])
    wanted = df.sparkSession.range(1).select(F.explode(rows).alias("d")).select("d.*")
    joined = wanted.join(per_column.select("c", "unique", "not_null", late), wanted["column_name"] == F.col("c"), "left")
    failing = F.when(F.col("test") == "unique", F.col("unique")).when(F.col("test") == "not_null", F.col("not_null")).otherwise(F.coalesce("fresh", F.lit(1)))
    out = joined.select(F.lit(table).alias("table_name"), "column_name", "test", F.coalesce(failing, F.lit(0)).alias("failing"))
    return out.withColumn("passed", F.col("failing") == 0)
