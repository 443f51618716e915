"""Joins with a twist: pattern lookups by priority, NULL-as-empty keys, IP ranges, merges by priority."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.cleaning import dash_to_null
from orderloom.functions.urls import IPV4_PREFIX, address_key
from orderloom.operators.dedup import first_per_key
from orderloom.operators.keys import bucket_of
from orderloom.session import shuffles_dropped


def fx_pick(items: DataFrame, rates: DataFrame, keys: Sequence[str] = (), tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Currency code and rate of each cart line; one row per `keys`.

    A rate fits when its symbol equals the line's symbol and its URL pattern is empty or matches the page.
    The lowest priority number wins; rates without a priority come last. No fit gives 'UNKNOWN' and 1.0.

    The rates of a symbol become one array in that order, so a line meets one row and takes its first fitting element;
    lines are not multiplied by rates. The window is left for repeated `keys` only; without `keys` every line is kept.
    """
    kind = rates.schema["rate_to_usd"].dataType
    choice = F.struct(
        F.coalesce("priority", F.lit(999)).alias("priority"), F.col("currency_code").alias("code"), F.col("rate_to_usd").alias("rate"),
        F.col("url_pattern").alias("pattern"),
    )
    by_symbol = rates.where(F.col("currency_symbol").isNotNull()).groupBy(F.col("currency_symbol").alias("_fx_symbol"))
    joined = items.join(by_symbol.agg(F.sort_array(F.collect_list(choice)).alias("_fx")), F.col("transaction_currency_symbol") == F.col("_fx_symbol"), "left")
    fits = F.filter("_fx", lambda c: c["pattern"].isNull() | (c["pattern"] == "") | F.like(F.col("current_url"), c["pattern"]))
    joined = joined.withColumn("_pick", F.get(fits, F.lit(0)))
    order = [F.coalesce("_pick.priority", F.lit(999)), F.col("_pick.code"), F.col("_pick.rate"), *tie_break]
    best = first_per_key(joined, keys, order) if keys else joined
    return best.select(
        *items.columns,
        F.coalesce("_pick.code", F.lit("UNKNOWN")).alias("transaction_currency_code"),
        F.coalesce("_pick.rate", F.lit(1).cast(kind)).alias("transaction_rate_to_usd"),
    )


def null_as_empty(left: Column, right: Column) -> Column:
    """Equality in which NULL and '' are the same value. Stays a hash-join key."""
    return F.coalesce(left, F.lit("")) == F.coalesce(right, F.lit(""))


def repeated(dim: DataFrame, key: str) -> bool:
    """Whether a value of `key` comes twice in `dim`."""
    with shuffles_dropped(dim.sparkSession):
        return not dim.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


def asked_for(lines: DataFrame, at: str, key: str, dim: DataFrame) -> DataFrame:
    """The rows of `dim` that each bucket `at` of `lines` asks for, with the bucket. Rows without a match are left out.

    So a large dimension comes to the lines, and wide lines need not be shuffled by `key`: what moves is the key, once
    per bucket, however often a bucket or the table repeats it.
    """
    return lines.select(at, key).where(F.col(key).isNotNull()).distinct().join(dim, key)


def join_in_buckets(lines: DataFrame, found: Mapping[str, DataFrame], at: str, tasks: int) -> DataFrame:
    """Left join of `lines` to what their buckets asked for, as {key: rows}; a key has one row in a bucket at most.

    Lines and found rows move once, by bucket, to so many tasks. There they are sorted by each key in turn, the found row
    of a key first, and its columns are handed on to the lines behind it. A join would shuffle the lines by every key.
    """
    together = lines.withColumn("_line", F.lit(True))
    for key, rows in found.items():
        known = rows.where(F.col(key).isNotNull()).withColumn("_line", F.lit(False))
        together = together.unionByName(known, allowMissingColumns=True)
    together = together.repartition(tasks, at)
    for key, rows in found.items():
        upto = Window.partitionBy(at, key).orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        values = [c for c in rows.columns if c not in (at, key)]
        together = together.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in values})
    return together.where("_line").drop("_line")


IP_SLICES = 8


def locate_ips(ips: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Country, region and city of each distinct IPv4 or IPv6 address from a table of disjoint ranges.

    `ranges`: start_ip, end_ip (inclusive; text of either family, or numbers of IPv4), country, region, city; '-' means
    unknown. Text that is no address gets NULLs.

    Both tables are cut at borders drawn from the range starts. In a bucket one sorted pass finds the last range that
    starts at or before an address; where there is none, it is the last range of an earlier bucket. So no address-range
    pairs are formed, whatever the width of a range. Ranges go to each of a few slices of their bucket, and addresses to
    one by hash, so a range that holds many of the addresses is no single task.
    """
    wanted = ips.select(F.col(ip).alias("ip")).where(F.col("ip").isNotNull()).distinct().withColumn("_at", address_key("ip"))
    ends = {c: address_key(c) if ranges.schema[c].dataType.simpleString() == "string" else _ipv4_key(F.col(c)) for c in ("start_ip", "end_ip")}
    place = F.struct(ends["end_ip"].alias("end"), *[F.col(c) for c in ("country", "region", "city")]).alias("_range")
    known = ranges.select(ends["start_ip"].alias("_at"), place).where("_at is not null")
    bucket = bucket_of(known, ["_at"])
    known = known.withColumn("_bucket", bucket)
    # one row per bucket that has ranges: what the buckets behind it begin with
    last = known.groupBy("_bucket").agg(F.max_by("_range", "_at").alias("_range"))
    slices = F.explode(F.sequence(F.lit(0), F.lit(IP_SLICES - 1))).alias("_slice")
    asked = wanted.select(
        # text that is no address is spread, else it would all meet in one task
        F.when(F.col("_at").isNull(), -1).otherwise(bucket).alias("_bucket"), F.pmod(F.xxhash64("ip"), F.lit(IP_SLICES)).cast("int").alias("_slice"),
        "_at", "ip",
    )
    lined_up = known.select("_bucket", slices, "_at", "_range").unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy("_bucket", "_slice").orderBy("_at", F.col("ip").asc_nulls_first())
    found = lined_up.withColumn("_inner", F.last("_range", ignorenulls=True).over(upto)).where("ip is not null")
    earlier = last.agg(F.sort_array(F.collect_list(F.struct("_bucket", "_range"))).alias("e")).scalar()  # as many entries as buckets
    before = F.try_element_at(F.filter("_ends", lambda e: e["_bucket"] < F.col("_bucket")), F.lit(-1))["_range"]
    chosen = found.withColumn("_ends", earlier).select("ip", "_at", F.coalesce("_inner", before).alias("_range"))
    hit = F.col("_at") <= F.col("_range.end")
    return chosen.select("ip", *[dash_to_null(F.when(hit, F.col(f"_range.{c}"))).alias(c) for c in ("country", "region", "city")])


def _ipv4_key(number: Column) -> Column:
    return F.concat(F.lit(IPV4_PREFIX), F.lpad(F.lower(F.hex(number.cast("bigint"))), 8, "0"))


def merge_by_key(base: DataFrame, key: str, *updates: DataFrame) -> DataFrame:
    """Replace rows of `base` by rows of `updates` with the same key; later updates win.

    An update must hold one row per key. Keys that only exist in an update are not added.
    """
    columns = base.columns
    merged = base.withColumn("_row", F.struct(*columns)).select(F.col(key).alias("_key"), "_row")
    for update in updates:
        latest = update.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
        merged = merged.join(latest, "_key", "left").select("_key", F.coalesce("_new", "_row").alias("_row"))
    return merged.select("_row.*")


def first_source_wins(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of `first`, and those rows of `second` whose key is new."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def not_yet_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
