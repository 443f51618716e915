"""Star schema: six dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import agents
from orderloom.functions.calendar import calendar_columns
from orderloom.functions.cleaning import natural_key
from orderloom.functions.history import beginning_of_time, end_of_time, row_hash
from orderloom.operators.history import CUSTOMER, HistorySpec, collapse_versions, initial_history
from orderloom.operators.keys import (
    BUCKETS_PER_PARTITION, add_small_surrogate_key, add_surrogate_key, bucket_of, bucket_offsets, number_in_buckets,
    with_unknown_members,
)
from orderloom.operators.lookups import asked_for, join_in_buckets, null_as_empty, repeated
from orderloom.session import broadcasts, packed, task_count

NO_DATE_KEY = 19000101


def _members(df: DataFrame, unknown: list, not_applicable: list) -> DataFrame:
    """Two fixed rows with the columns of `df`, as literals (no data moves)."""
    rows = []
    for values in (unknown, not_applicable):
        cells = [
            F.lit(v).cast(field.dataType).alias(field.name) for v, field in zip(values, df.schema, strict=True)
        ]
        rows.append(F.struct(*cells))
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def date_rows(days: DataFrame, column: str = "date_day", as_of: Column | None = None) -> DataFrame:
    """Calendar attributes for each row of `days`."""
    return days.select(*[v.alias(k) for k, v in calendar_columns(F.col(column), as_of).items()])


def dim_date(
    spark: SparkSession, first: str = "2015-01-01", last: str = "2030-12-31", as_of: Column | None = None
) -> DataFrame:
    """One row per calendar day."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return date_rows(spark.range(1).select(F.explode(span).alias("date_day")), "date_day", as_of)


def customer_rows(stg_events: DataFrame) -> DataFrame:
    """Sightings of identified customers."""
    return stg_events.select(
        natural_key("user_id_db", "device_id").alias("customer_natural_key"),
        "user_id_db",
        "device_id",
        "email_address",
        "event_timestamp",
    ).where(F.col("customer_natural_key").isNotNull())


def customer_members(history: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    blanks = [None] * (len(spec.carried) + len(spec.tracked))
    members = _members(
        history,
        [-1, "UNKNOWN", *blanks, None, None, True, None],
        [-2, "N/A", *blanks, None, None, True, None],
    )
    return members.withColumns(
        {"valid_from": beginning_of_time(), "valid_to": end_of_time(), "row_hash": row_hash([F.lit(None)])}
    )


def history_with_members(versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """First load of collapsed versions, plus the two fixed members."""
    history = initial_history(versions, spec)
    return with_unknown_members(history, customer_members(history, spec))


def dim_customer(stg_events: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """First load: every version of every customer, plus the two fixed members."""
    return history_with_members(collapse_versions(customer_rows(stg_events), spec), spec)


def dim_product(stg_products: DataFrame) -> DataFrame:
    body = stg_products.drop("status", "ingested_at")
    keyed = add_surrogate_key(body, "product_key", ["product_id"])
    members = _members(
        keyed,
        [-1, "UNKNOWN", "Unknown", "Unknown Product", "UNKNOWN", "Unknown", "Unknown", "Unknown", "-1",
         "Unknown", "USD", 0, 0, 0, 0],
        [-2, "N/A", "N/A", "Not Applicable", "N/A", "N/A", "N/A", "N/A", "-2", "N/A", "USD", 0, 0, 0, 0],
    )
    return with_unknown_members(keyed, members)


def dim_location(stg_ip_locations: DataFrame) -> DataFrame:
    places = (
        stg_ip_locations.where(F.col("country_name").isNotNull())
        .select("country_name", "region_name", "city_name", "geo_completeness_level")
        .distinct()
    )
    keyed = add_surrogate_key(places, "location_key", ["country_name", "region_name", "city_name"])
    members = _members(keyed, [-1, "Unknown", "Unknown", "Unknown", -1], [-2, "N/A", "N/A", "N/A", -2])
    return with_unknown_members(keyed, members)


def dim_device(checkouts: DataFrame) -> DataFrame:
    """Junk dimension of device classes. The rule tables bound it to a few dozen rows."""
    columns = ["device_category", "browser_name", "operating_system"]
    classes = checkouts.select(*columns).distinct()
    keyed = add_small_surrogate_key(classes, "device_key", columns)
    keyed = keyed.withColumn("is_mobile", agents.is_mobile("device_category"))
    members = _members(
        keyed, [-1, "Unknown", "Unknown", "Unknown", False], [-2, "N/A", "N/A", "N/A", False]
    )
    return with_unknown_members(keyed, members)


def dim_exchange_rate(exchange_rates: DataFrame) -> DataFrame:
    """Currencies of the seed table, as many as there are in the world. Blank and 'UNDEFINED' codes are left out."""
    code = F.col("currency_code")
    rates = exchange_rates.where((code != "") & (code != "UNDEFINED")).select(
        "currency_code", "rate_to_usd"
    ).distinct()
    keyed = add_small_surrogate_key(rates, "exchange_rate_key", ["currency_code", "rate_to_usd"])
    return with_unknown_members(keyed, _members(keyed, [-1, "UNKNOWN", 1], [-2, "N/A", 1]))


def fact_sales_order_line(
    items: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_location: DataFrame,
    dim_device: DataFrame,
    dim_exchange_rate: DataFrame,
) -> DataFrame:
    """Order lines with dimension keys and measures. Unmatched keys are -1, an unmatched day 19000101.

    All joins are left equi joins. Places, devices, rates and days are joined first; Spark broadcasts them when their
    measured size allows. Those lines are stored and then move once, to the bucket in which they are numbered; products
    and customers that are too many to broadcast come to the buckets (`lookups.asked_for`).
    """
    day = dim_date.select(F.col("full_date").alias("event_date"), "date_key")
    product = dim_product.select("product_id", "product_key")
    customer = dim_customer.where(F.col("is_current")).select("customer_natural_key", "customer_key")
    device = dim_device.select("device_category", "browser_name", "operating_system", "device_key")
    rate = dim_exchange_rate.select(F.col("currency_code").alias("transaction_currency_code"), "exchange_rate_key")
    place = dim_location.select(
        F.col("country_name").alias("_country"), F.col("region_name").alias("_region"),
        F.col("city_name").alias("_city"), "location_key",
    )
    same_place = (
        (F.col("country_name") == F.col("_country"))
        & null_as_empty(F.col("region_name"), F.col("_region"))
        & null_as_empty(F.col("city_name"), F.col("_city"))
    )
    small = (
        items.join(device, ["device_category", "browser_name", "operating_system"], "left")
        .join(place, same_place, "left")
        .join(rate, "transaction_currency_code", "left")
        .join(day, "event_date", "left")
    )
    # A key that a dimension has twice gives two lines; those must be there before lines are counted.
    large = {"product_id": product, "customer_natural_key": customer}
    for key, dim in list(large.items()):
        if broadcasts(dim) or repeated(dim, key):
            small = small.join(large.pop(key), key, "left")
    lines = packed(
        small.select(
            "event_id", "event_timestamp", "event_date", "date_key", "store_id", "ip_address", "order_id", "product_id",
            "customer_natural_key", "quantity", "transaction_price", "transaction_currency_symbol",
            "transaction_currency_code", "transaction_rate_to_usd", "is_recommendation_influenced",
            *[k for k in ("product_key", "customer_key") if k in small.columns],
            "location_key", "device_key", "exchange_rate_key",
        )
    )
    spark = items.sparkSession
    tasks = task_count(spark, lines.count())
    event = ["event_timestamp", "event_id"]
    placed = lines.withColumn("_bucket", bucket_of(lines, event, BUCKETS_PER_PARTITION * tasks))
    asks = packed(placed.select("_bucket", *large))  # read by every lookup
    found = {key: packed(asked_for(asks, "_bucket", key, dim)) for key, dim in large.items()}
    offsets = packed(bucket_offsets(asks, []))
    joined = join_in_buckets(placed, found, "_bucket", tasks)
    keyed = number_in_buckets(joined, offsets, [*event, "product_key", "product_id"], "sales_line_key")
    # Nine digits all the way. Precisions are chosen so that Spark keeps the scale of each product; an amount of more
    # than fifteen digits before the point is NULL instead of ending the job. All this when the lines have moved.
    price = F.col("transaction_price").try_cast("decimal(38,9)")
    total = F.col("quantity").try_cast("decimal(13,0)") * F.col("unit_price").try_cast("decimal(24,9)")
    rate_usd = F.coalesce("transaction_rate_to_usd", F.lit(1)).try_cast("decimal(15,9)")
    keyed = keyed.select(
        F.col("sales_line_key").cast("bigint").alias("sales_line_key"),
        "event_date",
        F.coalesce("date_key", F.lit(NO_DATE_KEY)).alias("date_key"),
        *[
            F.coalesce(k, F.lit(-1)).cast("bigint").alias(k)
            for k in ("product_key", "customer_key", "location_key", "device_key", "exchange_rate_key")
        ],
        "event_id", "order_id", "store_id", "ip_address", "quantity",
        price.alias("unit_price"),
        "transaction_currency_symbol", "transaction_currency_code",
        rate_usd.alias("_rate"),
        "is_recommendation_influenced",
        F.col("event_timestamp").alias("order_timestamp"),
    )
    usd = (F.col("line_total").try_cast("decimal(22,9)") * F.col("_rate")).try_cast("decimal(38,9)")
    keyed = keyed.withColumn("line_total", total).withColumn("line_total_usd", usd)
    return keyed.select(
        "sales_line_key", "event_date", "date_key", "product_key", "customer_key", "location_key", "device_key",
        "exchange_rate_key", "event_id", "order_id", "store_id", "ip_address", "quantity", "unit_price",
        "transaction_currency_symbol", "transaction_currency_code", "line_total", "line_total_usd",
        "is_recommendation_influenced", "order_timestamp",
    )
