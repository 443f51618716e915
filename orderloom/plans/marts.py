"""Dashboard marts over enriched sales lines.

All marts drop outlier orders. The marts by store and place flag the first line of every order in its group, then count
customers: the lines are spread by (group, order), then combined on the map side and spread by (group, customer), so a hot
store or place never meets in one task, and no row is multiplied as by two distinct counts at once. Calendar columns
are joined to the finished groups; Spark broadcasts the calendar and the device classes when their measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.cleaning import email_domain, purchase_segment
from orderloom.operators.dedup import top_value_per_key
from orderloom.session import packed

DAILY_KEYS = ["order_date", "store_id", "device_category", "is_mobile"]
PLACE_KEYS = ["order_date", "country_name", "region_name", "city_name"]


def clean_sales(sales: DataFrame, newer_than: Column | None = None) -> DataFrame:
    """Lines of normal orders; an incremental run adds the date filter, which prunes day partitions."""
    rows = sales.where(~F.col("is_outlier"))
    return rows if newer_than is None else rows.where(F.col("order_date") > newer_than)


def _calendar(dim_date: DataFrame, columns: Sequence[str]) -> DataFrame:
    return dim_date.select(F.col("full_date").alias("order_date"), *columns)


def _first_of_order(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`lines` with the flag `_first_of_order`: whether this is the first line of its order in its group of `keys`.

    Lines are spread by order and group unless those of an order lie together already. The order comes first, as it
    alone tells most lines apart when they are sorted.
    """
    same = Window.partitionBy("order_id", *keys).orderBy("order_id")
    return lines.withColumn("_first_of_order", F.col("order_id").isNotNull() & (F.row_number().over(same) == 1))


def _first_lines(lines: DataFrame, keys: Sequence[str], **flags: str) -> DataFrame:
    """`lines` with a flag for each named column: whether this is the first line of its value in its group of `keys`.

    Counting the flags is counting distinct values, with one shuffle by `keys` and a sort per column; count_distinct of
    two columns triples the rows and shuffles them three times. For groups of which none is a large part of the table.
    """
    out = lines.repartition(*keys)
    for column, flag in flags.items():
        same = Window.partitionBy(*keys, column).orderBy(column)
        out = out.withColumn(flag, F.col(column).isNotNull() & (F.row_number().over(same) == 1))
    return out


def _measures() -> list[Column]:
    """Measures of a group of flagged lines; a single distinct count does not multiply the rows."""
    return [
        F.count_if("_first_of_order").alias("order_count"),
        F.count("*").alias("line_item_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total_usd").alias("revenue_usd"),
        F.count_distinct("customer_key").alias("unique_customers"),
    ]


def mart_sales_daily(
    sales: DataFrame, dim_device: DataFrame, dim_date: DataFrame, newer_than: Column | None = None
) -> DataFrame:
    """Store × day × device class. The guest and registered columns count lines."""
    devices = dim_device.select("device_key", "device_category", "is_mobile")
    lines = clean_sales(sales, newer_than).join(devices, "device_key", "left")
    days = _first_of_order(lines, DAILY_KEYS).groupBy(*DAILY_KEYS).agg(
        *_measures(),
        F.count_if("is_guest").alias("guest_orders"),
        F.count_if(~F.col("is_guest")).alias("registered_orders"),
    )
    attributes = ["year", "quarter", "month", F.col("week").alias("week_of_year"), "day_of_week", "day_name", "is_weekend"]
    return days.join(_calendar(dim_date, attributes), "order_date", "left").select(
        *DAILY_KEYS,
        "year", "quarter", "month", "week_of_year", "day_of_week", "day_name", "is_weekend",
        "order_count", "line_item_count", "units_sold", "revenue_usd", "unique_customers",
        "guest_orders", "registered_orders",
    )


def mart_sales_by_geography(
    sales: DataFrame, dim_location: DataFrame, dim_date: DataFrame, newer_than: Column | None = None
) -> DataFrame:
    """Country × region × city × day, for lines whose city is known."""
    places = dim_location.where(F.col("city_name").isNotNull()).select("location_key", *PLACE_KEYS[1:])
    lines = clean_sales(sales, newer_than).join(places, "location_key")
    days = _first_of_order(lines, PLACE_KEYS).groupBy(*PLACE_KEYS).agg(*_measures())
    return days.join(_calendar(dim_date, ["year", "month"]), "order_date", "left").select(
        *PLACE_KEYS, "year", "month",
        "order_count", "line_item_count", "units_sold", "revenue_usd", "unique_customers",
    )


def mart_sales_by_product(
    sales: DataFrame, dim_product: DataFrame, dim_date: DataFrame, newer_than: Column | None = None
) -> DataFrame:
    """Product × day. Sales are totalled by product key before the wide product columns are joined.

    A product seldom comes twice in an order, so order totals would be as many as lines, and a group is small.
    """
    attributes = [
        "product_id", "product_name", "sku", "product_type", "category_id", "category_name",
        "collection_name", "gender",
    ]
    keys = ["order_date", "product_key"]
    lines = clean_sales(sales, newer_than).select(
        *keys, "order_id", "quantity", "line_total_usd", "unit_price", "is_guest", email_domain("email_address").alias("_domain")
    )
    days = _first_lines(lines, keys, order_id="_first_of_order", _domain="_first_of_domain").groupBy(*keys).agg(
        F.count_if("_first_of_order").alias("order_count"),
        F.count("*").alias("line_item_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total_usd").alias("revenue_usd"),
        F.try_divide(F.sum("unit_price"), F.count("unit_price")).alias("avg_unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        F.count_if(~F.col("is_guest")).alias("registered_customer_orders"),
        F.count_if("is_guest").alias("guest_orders"),
        F.count_if("_first_of_domain").alias("unique_email_domains"),
    )
    money = "decimal(38,9)"
    products = dim_product.select(
        "product_key", *attributes,
        F.col("price").cast(money).alias("catalog_price"),
        F.col("min_price").cast(money).alias("catalog_min_price"),
        F.col("max_price").cast(money).alias("catalog_max_price"),
        F.col("gold_weight").cast(money).alias("gold_weight"),
        F.col("currency_code").alias("catalog_currency"),
    )
    return (
        days.join(products, "product_key")
        .join(_calendar(dim_date, ["year", "month"]), "order_date", "left")
        .select(
            "order_date", *attributes, "catalog_price", "catalog_min_price", "catalog_max_price",
            "gold_weight", "catalog_currency", "year", "month", "order_count", "line_item_count",
            "units_sold", "revenue_usd", "avg_unit_price", "min_unit_price", "max_unit_price",
            "registered_customer_orders", "guest_orders", "unique_email_domains",
        )
    )


def mart_customer_summary(
    sales: DataFrame, dim_device: DataFrame, dim_location: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Lifetime totals, preferences and segment per customer."""
    today = F.current_date() if as_of is None else as_of
    devices = dim_device.select("device_key", "device_category")
    places = dim_location.select("location_key", "country_name")
    lines = clean_sales(sales).join(devices, "device_key", "left").join(places, "location_key", "left")
    person = ["customer_key", "customer_natural_key", "email_address", "is_guest"]
    # Order grain, stored once: four steps read different columns of it.
    orders = packed(
        lines.groupBy(*person, "order_id", "device_category", "country_name").agg(
            F.min("order_date").alias("_first"),
            F.max("order_date").alias("_last"),
            F.sum("line_total_usd").alias("_revenue"),
            F.sum("quantity").alias("_units"),
            F.count("*").alias("_lines"),
        )
    )
    metrics = orders.groupBy("customer_key").agg(
        F.min("_first").alias("first_order_date"),
        F.max("_last").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("_revenue").alias("total_revenue_usd"),
        F.sum("_units").alias("total_units_purchased"),
    )
    device = top_value_per_key(orders, "customer_key", "device_category", "primary_device_category", "_lines")
    country = top_value_per_key(orders, "customer_key", "country_name", "primary_country", "_lines")
    who = orders.select(*person).distinct()
    domain = F.when(F.col("email_address").isNull(), "Guest").otherwise(email_domain("email_address"))
    return (
        who.join(metrics, "customer_key")
        .join(device, "customer_key")
        .join(country, "customer_key")
        .select(
            "customer_key", "customer_natural_key", "email_address", domain.alias("email_domain"), "is_guest",
            "first_order_date", "last_order_date",
            F.date_diff("last_order_date", "first_order_date").alias("days_between_first_last"),
            F.date_diff(today, "last_order_date").alias("days_since_last_order"),
            "total_orders", "total_revenue_usd",
            F.try_divide("total_revenue_usd", "total_orders").alias("avg_order_value"),
            "total_units_purchased", "primary_device_category", "primary_country",
            purchase_segment("total_orders").alias("purchase_frequency_segment"),
        )
    )
