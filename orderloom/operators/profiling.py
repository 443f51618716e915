"""Table profiling. Each function is one aggregation over one table.

Filter the table to an ingestion date first when it is partitioned by one; the filter prunes files.
Distinct counts are exact by default. For wide profiles of very large tables pass `approximate=True`:
the sketches need no shuffle of values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import urls
from orderloom.functions.cleaning import average, is_blank, percent, safe_double
from orderloom.operators.quantiles import quantile_columns


def _distinct(column: str | Column, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def _missing(column: str, blank_is_null: bool) -> Column:
    return F.coalesce(is_blank(column), F.lit(True)) if blank_is_null else F.col(column).isNull()


def has_value(column: str) -> Column:
    return ~F.coalesce(is_blank(column), F.lit(True))


def no_place() -> Column:
    return ~has_value("country") & ~has_value("region") & ~has_value("city")


def full_place() -> Column:
    return has_value("country") & has_value("region") & has_value("city")


def count_and_percent(hits: Mapping[str, Column], digits: int = 2) -> list[Column]:
    """For each named condition its row count and its percentage of all rows."""
    out = []
    for name, condition in hits.items():
        n = F.count_if(condition)
        out += [n.alias(f"{name}_count"), percent(n, F.count("*"), digits).alias(f"{name}_pct")]
    return out


def partitions(df: DataFrame, latest: int = 3, extra: Sequence[Column] = ()) -> DataFrame:
    """Rows per ingestion date, newest first."""
    days = df.groupBy(F.to_date("ingested_at").alias("partition_date")).agg(F.count("*").alias("row_count"), *extra)
    return days.orderBy(F.col("partition_date").desc()).limit(latest)


def basic(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Rows, distinct keys, uniqueness, ingestion period."""
    days = F.to_date("ingested_at")
    keys = _distinct(key, approximate)
    return df.agg(
        F.count("*").alias("total_rows"),
        keys.alias("distinct_keys"),
        percent(keys, F.count("*")).alias("uniqueness_pct"),
        F.min(days).alias("earliest_ingestion_date"),
        F.max(days).alias("latest_ingestion_date"),
        F.date_diff(F.max(days), F.min(days)).cast("bigint").alias("ingestion_period_days"),
    )


def nulls(
    df: DataFrame,
    columns: Sequence[str],
    blank_is_null: bool | Sequence[str] = False,
    distinct: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Present count, missing count and missing share of each column, and chosen distinct counts."""
    out = [F.count("*").alias("total_rows")]
    for name in columns:
        blank = blank_is_null if isinstance(blank_is_null, bool) else name in blank_is_null
        gone = F.count_if(_missing(name, blank))
        out += [
            (F.count("*") - gone).alias(f"non_null_{name}"),
            gone.alias(f"null_{name}_count"),
            percent(gone, F.count("*")).alias(f"null_{name}_pct"),
        ]
    out += [_distinct(name, approximate).alias(f"distinct_{name}") for name in distinct]
    out += count_and_percent(extra or {})
    return df.agg(*out)


def nulls_on_sample(df: DataFrame, columns: Sequence[str], fraction: float, key: str) -> DataFrame:
    """Null rates on the rows whose key hashes below `fraction`: the same sample on every run and engine."""
    place = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(2**32)
    return nulls(df.where(place < fraction), columns, blank_is_null=True)


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values of many columns.

    The exact form counts (column, value) pairs: values are combined on the map side, then one shuffle
    spreads them by value. It avoids one copy of each row per column in one wide aggregation.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(f"distinct_{c}") for c in columns])
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])).alias("p")
    ).select("p.c", "p.v")
    values = pairs.where(F.col("v").isNotNull()).distinct()
    return values.agg(*[F.count_if(F.col("c") == c).alias(f"distinct_{c}") for c in columns])


def primary_key(df: DataFrame, key: str, blank_is_null: bool = False) -> DataFrame:
    """Duplicates, missing keys and uniqueness of a key column."""
    keys, gone = F.count_distinct(key), F.count_if(_missing(key, blank_is_null))
    return df.agg(
        F.count("*").alias("total_rows"),
        keys.alias("distinct_keys"),
        (F.count("*") - keys).alias("duplicate_count"),
        percent(F.count("*") - keys, F.count("*")).alias("duplicate_pct"),
        gone.alias("null_count"),
        percent(gone, F.count("*")).alias("null_pct"),
        percent(keys, F.count("*")).alias("uniqueness_rate"),
    )


def top_duplicates(df: DataFrame, key: str, size: int, extra: Sequence[Column] = (), skip_blank: bool = False) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    rows = df.where(has_value(key)) if skip_blank else df
    counts = rows.groupBy(key).agg(F.count("*").alias("occurrences"), *extra)
    return counts.where(F.col("occurrences") > 1).orderBy(F.col("occurrences").desc(), key).limit(size)


def joined_values(df: DataFrame, keys: Sequence[str], column: str, alias: str, limit: int, sep: str = ", ") -> DataFrame:
    """The first `limit` distinct values of each key in order, as one text.

    Only `limit` values per key are ever gathered, however many there are.
    """
    from orderloom.sources.exports import first_per_type

    values = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    values = first_per_type(values, keys, [column], limit)
    lists = values.groupBy(*keys).agg(F.array_sort(F.collect_list(column)).alias("_v"))
    return lists.select(*keys, F.array_join("_v", sep).alias(alias))


def price_statistics(df: DataFrame, price: str = "price") -> DataFrame:
    """Statistics of prices kept as text; text that is no number is ignored."""
    value = safe_double(price)
    median = quantile_columns(df.select(value.alias("_p")), "_p", {"m": "0.5"}).scalar()
    gone = F.count_if(F.col(price).isNull())
    return df.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - gone).alias("non_null_price"),
        gone.alias("null_price_count"),
        percent(gone, F.count("*")).alias("null_price_pct"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
        F.round(F.avg(value), 2).alias("avg_price"),
        F.round(F.stddev(value), 2).alias("stddev_price"),
        F.count_if(value <= 0).alias("invalid_price_count"),
    ).withColumn("median_price", median)


def price_by_group(df: DataFrame, group: str, price: str, quantiles: Mapping[str, str], averages: Sequence[str] = ()) -> DataFrame:
    """Price statistics per currency (or another group), with exact quantiles."""
    rows = df.where(F.col(group).isNotNull()).withColumn("_p", safe_double(price))
    stats = rows.groupBy(group).agg(
        F.count("*").alias("row_count"),
        F.count_if(has_value(price)).alias("with_price"),
        F.round(F.avg("_p"), 2).alias("avg_price"),
        F.min("_p").alias("min_price"),
        F.max("_p").alias("max_price"),
        *[F.round(F.avg(safe_double(c)), 2).alias(f"avg_{c}") for c in averages],
    )
    return stats.join(quantile_columns(rows, "_p", dict(quantiles), [group]), group, "left")


def temporal(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Range of event times; future and implausibly old ones."""
    at = F.timestamp_seconds(F.col("time_stamp"))
    now = F.current_timestamp() if now is None else now
    gone = F.count_if(F.col("time_stamp").isNull())
    return df.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - gone).alias("non_null_timestamp"),
        gone.alias("null_timestamp_count"),
        percent(gone, F.count("*")).alias("null_timestamp_pct"),
        F.min(at).alias("min_timestamp"),
        F.max(at).alias("max_timestamp"),
        F.date_diff(F.max(at), F.min(at)).cast("bigint").alias("timestamp_range_days"),
        F.count_if(at > now).alias("future_timestamps"),
        F.count_if(at < F.to_timestamp(F.lit("2019-01-01"))).alias("pre_2019_timestamps"),
        F.min("ingested_at").alias("min_ingested_at"),
        F.max("ingested_at").alias("max_ingested_at"),
    )


def nested_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often arrays are filled, and their average, median and largest length."""
    out = [F.count("*").alias("total_rows")]
    medians = {}
    for name in columns:
        length = F.size(F.col(name))
        filled = F.count_if(length > 0)
        out += [
            filled.alias(f"with_{name}"),
            percent(filled, F.count("*")).alias(f"with_{name}_pct"),
            (F.count("*") - filled).alias(f"without_{name}"),
            percent(F.count("*") - filled, F.count("*")).alias(f"without_{name}_pct"),
            average(F.sum(length), F.count(length)).alias(f"avg_{name}"),
            F.max(length).cast("bigint").alias(f"max_{name}"),
        ]
        sizes = df.select(F.size(F.col(name)).cast("bigint").alias("_s"))
        medians[f"median_{name}"] = quantile_columns(sizes, "_s", {"m": "0.5"}).scalar()
    return df.agg(*out).withColumns(medians)


def string_lengths(df: DataFrame, columns: Sequence[str], skip_blank: Sequence[str] = ()) -> DataFrame:
    """Average, shortest and longest text of each column."""
    out = []
    for name in columns:
        length = F.length(name)
        if name in skip_blank:
            length = F.when(has_value(name), length)
        out += [
            average(F.sum(length), F.count(length)).alias(f"avg_{name}_length"),
            F.min(length).cast("bigint").alias(f"min_{name}_length"),
            F.max(length).cast("bigint").alias(f"max_{name}_length"),
        ]
    return df.agg(*out)


def top_groups(df: DataFrame, by: Sequence[str], size: int | None = None, extra: Sequence[Column] = (), digits: int = 2) -> DataFrame:
    """Groups with count, share of all rows and further measures, largest first."""
    groups = df.groupBy(*by).agg(F.count("*").alias("row_count"), *extra)
    total = df.agg(F.count("*").alias("n")).scalar()
    shared = groups.withColumn("percentage", percent(F.col("row_count"), total, digits))
    return shared if size is None else shared.orderBy(F.col("row_count").desc(), *by).limit(size)


def crosstab_presence(df: DataFrame, by: str, columns: Mapping[str, Column], size: int | None = None) -> DataFrame:
    """Per group, how many rows satisfy each named condition."""
    groups = df.groupBy(by).agg(F.count("*").alias("row_count"), *count_and_percent(columns))
    return groups if size is None else groups.orderBy(F.col("row_count").desc(), by).limit(size)


def issues(df: DataFrame, conditions: Mapping[str, Column], digits: int = 4) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), *count_and_percent(conditions, digits))


def store_out_of_range(store: str = "store_id", low: int = 1, high: int = 86) -> Column:
    """TRUE for store ids that are no number or lie outside the known range."""
    return F.coalesce(~F.col(store).try_cast("bigint").between(low, high), F.lit(True))


def event_issues(df: DataFrame, now: Column | None = None) -> DataFrame:
    at = F.timestamp_seconds(F.col("time_stamp"))
    now = F.current_timestamp() if now is None else now
    duplicates = F.count("*") - F.count_distinct("_id")
    flagged = count_and_percent(
        {
            "future_timestamps": at > now,
            "very_old_timestamps": at < F.to_timestamp(F.lit("2019-01-01")),
            "invalid_store_ids": store_out_of_range(),
            "missing_critical_fields": F.col("_id").isNull() | F.col("collection").isNull() | F.col("time_stamp").isNull(),
            "invalid_prices": safe_double("price") <= 0,
        },
        4,
    )
    return df.agg(
        duplicates.alias("duplicate_event_ids_count"),
        percent(duplicates, F.count("*"), 4).alias("duplicate_event_ids_pct"),
        *flagged,
    )


def ip_issues(df: DataFrame) -> DataFrame:
    odd = has_value("ip") & ~urls.is_ipv4("ip") & ~urls.is_ipv6("ip")
    dashes = (F.col("country") == "-") | (F.col("city") == "-") | (F.col("region") == "-")
    return df.agg(
        F.count("*").alias("total_rows"),
        *count_and_percent({"missing_ip": ~has_value("ip"), "no_geographic_data": no_place()}),
        F.count_if(odd).alias("invalid_ip_formats"),
        F.count_if(has_value("country") & (F.length("country") <= 1)).alias("suspicious_country_values"),
        F.count_if(has_value("city") & (F.length("city") <= 1)).alias("suspicious_city_values"),
        F.count_if(dashes).alias("placeholder_values"),
    )


def product_issues(df: DataFrame) -> DataFrame:
    duplicates = F.count("*") - F.count_distinct("product_id")
    failed = F.count_if(F.col("status") != "success")
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~has_value("product_id")).alias("missing_product_id"),
        duplicates.alias("duplicate_product_ids"),
        percent(duplicates, F.count("*")).alias("duplicate_pct"),
        failed.alias("failed_crawls"),
        percent(failed, F.count("*")).alias("failed_crawl_pct"),
        F.count_if(~has_value("product_id") | ~has_value("url")).alias("products_missing_identifiers"),
        F.count_if(has_value("price") & (safe_double("price") <= 0)).alias("invalid_prices"),
        F.count_if(has_value("price") & ~has_value("currency_code")).alias("price_without_currency"),
        F.count_if(has_value("product_name") & (F.length("product_name") < 3)).alias("very_short_names"),
        F.count_if(~has_value("category")).alias("no_category"),
        F.count_if(~has_value("primary_image_url")).alias("no_image"),
    )


def price_consistency(df: DataFrame) -> DataFrame:
    """Rules on minimum, current and maximum price, and on what a successful crawl must have."""
    low, price, high = (safe_double(c) for c in ("min_price", "price", "max_price"))
    done = F.col("status") == "success"
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(low.isNotNull() & price.isNotNull() & high.isNotNull()).alias("records_with_all_prices"),
        F.count_if(low > price).alias("min_price_exceeds_price"),
        F.count_if(price > high).alias("price_exceeds_max_price"),
        F.count_if(low > high).alias("min_exceeds_max"),
        F.count_if(done & ~has_value("product_name")).alias("success_but_no_name"),
        F.count_if(done & ~has_value("price")).alias("success_but_no_price"),
    )


def price_currency_rule(df: DataFrame) -> DataFrame:
    """Rows with a price must have a currency."""
    priced, both = F.col("price").isNotNull(), F.col("price").isNotNull() & F.col("currency").isNotNull()
    return df.agg(
        F.count_if(priced).alias("events_with_price"),
        F.count_if(both).alias("events_with_both"),
        F.count_if(priced & F.col("currency").isNull()).alias("violation_count"),
        percent(F.count_if(priced & F.col("currency").isNull()), F.count_if(priced)).alias("violation_pct"),
        percent(F.count_if(both), F.count_if(priced)).alias("compliance_rate"),
    )


def bot_sessions(df: DataFrame, session: str = "device_id", more_than: int = 1000) -> DataFrame:
    """Sessions with suspiciously many events."""
    sizes = df.where(F.col(session).isNotNull()).groupBy(session).agg(F.count("*").alias("n"))
    return sizes.where(F.col("n") > more_than).agg(
        F.count("*").alias("suspicious_large_sessions"),
        F.min("n").alias("min_session_size"),
        F.max("n").alias("max_session_size"),
        average(F.sum("n"), F.count("n")).alias("avg_session_size"),
    )


def geo_coverage(df: DataFrame) -> DataFrame:
    """Distinct places, and addresses that have all three parts."""
    out = []
    for name, plural in (("country", "countries"), ("region", "regions"), ("city", "cities")):
        out.append(F.count_distinct(name).alias(f"distinct_{plural}"))
        out.append(F.count_distinct(F.when(has_value(name), F.col(name))).alias(f"distinct_non_empty_{plural}"))
    complete = F.count_distinct(F.when(full_place(), F.col("ip")))
    out += [
        complete.alias("ips_with_complete_data"),
        percent(complete, F.count_distinct("ip")).alias("complete_data_pct"),
    ]
    return df.agg(*out)


def geo_levels(df: DataFrame) -> DataFrame:
    """Rows per exact completeness pattern."""
    country, region, city = (has_value(c) for c in ("country", "region", "city"))
    return df.agg(
        *count_and_percent(
            {
                "level0_no_data": no_place(),
                "level1_country_only": country & ~region & ~city,
                "level2_country_region": country & region & ~city,
                "level3_complete": full_place(),
            }
        )
    )


def country_summary(df: DataFrame, size: int = 20) -> DataFrame:
    groups = df.where(has_value("country")).groupBy("country").agg(
        F.count("*").alias("total_ips"),
        F.count_distinct("ip").alias("distinct_ips"),
        F.count_distinct("region").alias("distinct_regions"),
        F.count_distinct("city").alias("distinct_cities"),
        percent(F.count_if(has_value("region")), F.count("*")).alias("region_populated_pct"),
        percent(F.count_if(has_value("city")), F.count("*")).alias("city_populated_pct"),
    )
    return groups.orderBy(F.col("total_ips").desc(), "country").limit(size)


def ip_formats(df: DataFrame) -> DataFrame:
    four, six = urls.is_ipv4("ip"), urls.is_ipv6("ip")
    return df.agg(
        F.count("*").alias("total_rows"),
        *count_and_percent({"ipv4_format": four, "ipv6_format": six, "invalid_format": ~four & ~six}),
    )


def ip_kinds(df: DataFrame) -> DataFrame:
    """Private, loopback and public IPv4 addresses."""
    private, loopback = urls.is_private_ip("ip"), urls.is_loopback_ip("ip")
    return df.where(urls.is_ipv4("ip")).agg(
        F.count("*").alias("total_ips"),
        *count_and_percent({"private_ips": private, "localhost_ips": loopback, "public_ips": ~private & ~loopback}),
    )


def url_formats(df: DataFrame) -> DataFrame:
    url, image = F.col("url"), F.col("primary_image_url")
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(url.startswith("http")).alias("urls_with_http"),
        F.count_if(url.startswith("https")).alias("urls_with_https"),
        percent(F.count_if(url.startswith("https")), F.count("*")).alias("https_pct"),
        F.count_if(has_value("primary_image_url")).alias("products_with_image"),
        F.count_if(image.startswith("https")).alias("images_with_https"),
        F.count_if(has_value("primary_video_url")).alias("products_with_video"),
        F.count_if(has_value("url") & has_value("primary_image_url")).alias("products_with_url_and_image"),
    )


def ip_coverage(events: DataFrame, locations: DataFrame) -> DataFrame:
    """How many distinct event addresses have a location. Both sides are reduced to distinct addresses first."""
    asked = events.select("ip").where(F.col("ip").isNotNull()).distinct()
    known = locations.select(F.col("ip").alias("known_ip")).where(F.col("ip").isNotNull()).distinct()
    joined = asked.join(known, F.col("ip") == F.col("known_ip"), "left")
    matched = F.count("known_ip")
    return joined.agg(
        F.count("*").alias("event_distinct_ips"),
        matched.alias("ip_locations_distinct_ips"),
        matched.alias("matched_ips"),
        percent(matched, F.count("*")).alias("coverage_pct"),
    )


def column_metadata(df: DataFrame, table: str) -> DataFrame:
    """Name, type, mode and nullability of every column, with its filled rows (one scan)."""
    described = []
    for position, field in enumerate(df.schema.fields, 1):
        kind = field.dataType.simpleString()
        mode = "REPEATED" if kind.startswith("array") else "RECORD" if kind.startswith("struct") else "SCALAR"
        described.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                F.lit(position).cast("bigint").alias("ordinal_position"),
                F.lit(kind).alias("data_type"),
                F.lit(mode).alias("field_mode"),
                F.lit(field.nullable).alias("is_nullable"),
                F.col(f"_n{position}").alias("filled_rows"),
            )
        )
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}") for i, f in enumerate(df.schema.fields, 1)])
    return counts.select(F.explode(F.array(*described)).alias("c")).select("c.*")


def file_metadata(df: DataFrame, table: str) -> DataFrame:
    """Rows, bytes on disk and bytes per row of a file-based table."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("bytes"), F.count("*").alias("rows")
    )
    return files.agg(F.sum("rows").alias("row_count"), F.sum("bytes").alias("size_bytes")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        "size_bytes",
        F.round(F.try_divide("size_bytes", "row_count"), 0).alias("avg_bytes_per_row"),
    )
