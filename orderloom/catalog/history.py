"""Keys, slowly changing dimensions and incremental tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.registry import query, scratch
from orderloom.catalog.standins import duck, table, view
from orderloom.functions import history as h
from orderloom.operators import history as scd
from orderloom.operators.keys import add_surrogate_key, max_key, with_unknown_members
from orderloom.plans import core, incremental
from orderloom.session import stored

# Sightings: the priority of a customer's orders plays the tracked attribute. Days make ties.
SEEN = """SELECT CAST(o_custkey AS STRING) AS customer_natural_key, CAST(o_custkey AS STRING) AS user_id_db,
  'd' || CAST(o_orderkey % 7 AS STRING) AS device_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS email_address,
  CAST(o_orderdate AS TIMESTAMP) AS event_timestamp, o_orderkey FROM {orders}"""
VERSIONS = """SELECT customer_natural_key, email_address, max(user_id_db) AS user_id_db, max(device_id) AS device_id,
  min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen, md5(coalesce(email_address, '')) AS row_hash
FROM {seen} GROUP BY 1, 2"""
ORDER = "first_seen, email_address NULLS FIRST"
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
DUCK_SEEN = SEEN.format(orders="orders").replace("STRING", "VARCHAR")
DUCK_VERSIONS = VERSIONS.format(seen="seen")
# The first load sees the orders before 1996, the incremental run sees all.
OLD = "SELECT * FROM seen WHERE event_timestamp < TIMESTAMP '1996-01-01'"
DUCK_HISTORY = f"""SELECT row_number() OVER (ORDER BY customer_natural_key, {ORDER}) AS customer_key, customer_natural_key, user_id_db, device_id,
  email_address, first_seen AS valid_from, coalesce(lead(first_seen) OVER w, TIMESTAMP '9999-12-31') AS valid_to,
  lead(first_seen) OVER w IS NULL AS is_current, row_hash FROM {{versions}} WINDOW w AS (PARTITION BY customer_natural_key ORDER BY {ORDER})"""
SHOW = f"""CAST(customer_key AS BIGINT) AS customer_key, customer_natural_key, user_id_db, device_id, email_address,
  {TS.format('valid_from')} AS valid_from, {TS.format('valid_to')} AS valid_to, is_current, row_hash"""
NOW = "2002-01-01 00:00:00"


def _seen(spark, sf, before: str | None = None):
    orders = table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("customer_natural_key"),
        F.col("o_custkey").cast("string").alias("user_id_db"),
        F.concat(F.lit("d"), (F.col("o_orderkey") % 7).cast("string")).alias("device_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("email_address"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
    )
    return rows if before is None else rows.where(F.col("event_timestamp") < F.to_timestamp(F.lit(before)))


def _versions(spark, sf, before=None):
    return scd.collapse_versions(_seen(spark, sf, before))


def _history(spark, sf):
    """Stored history of the orders before 1996 and the versions staged from all orders."""
    old = scd.initial_history(_versions(spark, sf, "1996-01-01"))
    return stored(with_unknown_members(old, core.customer_members(old))), _versions(spark, sf)


def _now():
    return F.to_timestamp(F.lit(NOW))


@query(
    "surrogate_key_global",
    """SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS line_key,
      l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey FROM lineitem""",
)
def surrogate_key_global(spark, sf):
    """Dense keys in a global order, numbered in parallel."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    keyed = add_surrogate_key(li, "line_key", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return keyed.select("line_key", "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "surrogate_key_incremental",
    """WITH old AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS k, o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
    SELECT CAST(row_number() OVER (ORDER BY o_orderkey) + (SELECT max(k) FROM old) AS BIGINT) AS order_key, o_orderkey
    FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
)
def surrogate_key_incremental(spark, sf):
    """New rows continue behind the largest stored key."""
    orders = table(spark, sf, "orders")
    split = F.lit("1999-01-01").cast("timestamp_ntz")
    old = add_surrogate_key(orders.where(F.col("o_orderdate") < split).select("o_orderkey"), "order_key", ["o_orderkey"])
    fresh = orders.where(F.col("o_orderdate") >= split).select("o_orderkey")
    return add_surrogate_key(fresh, "order_key", ["o_orderkey"], max_key(old, "order_key"))


@query("scd2_row_hash", duck("SELECT o_orderkey, md5(coalesce(email_address, '') || device_id) AS row_hash FROM seen", seen=DUCK_SEEN))
def scd2_row_hash(spark, sf):
    orders = table(spark, sf, "orders")
    email = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    device = F.concat(F.lit("d"), (F.col("o_orderkey") % 7).cast("string"))
    return orders.select("o_orderkey", h.row_hash([email, device]).alias("row_hash"))


@query(
    "scd2_valid_to",
    duck(
        f"""SELECT customer_natural_key, email_address, {TS.format(f"coalesce(lead(first_seen) OVER (PARTITION BY customer_natural_key ORDER BY {ORDER}), TIMESTAMP '9999-12-31')")} AS valid_to FROM versions""",
        seen=DUCK_SEEN,
        versions=DUCK_VERSIONS,
    ),
)
def scd2_valid_to(spark, sf):
    v = _versions(spark, sf)
    return v.select("customer_natural_key", "email_address", h.valid_to("first_seen", "customer_natural_key", ["email_address"]).alias("valid_to"))


@query(
    "scd2_is_current",
    duck(
        f"SELECT customer_natural_key, email_address, lead(first_seen) OVER (PARTITION BY customer_natural_key ORDER BY {ORDER}) IS NULL AS is_current FROM versions",
        seen=DUCK_SEEN,
        versions=DUCK_VERSIONS,
    ),
)
def scd2_is_current(spark, sf):
    v = _versions(spark, sf)
    return v.select("customer_natural_key", "email_address", h.is_current("first_seen", "customer_natural_key", ["email_address"]).alias("is_current"))


@query(
    "scd2_version_number",
    duck(
        f"""SELECT customer_natural_key, email_address, device_id, {TS.format('first_seen')} AS first_seen, {TS.format('last_seen')} AS last_seen,
          row_hash, CAST(row_number() OVER (PARTITION BY customer_natural_key ORDER BY {ORDER}) AS BIGINT) AS version_number FROM versions""",
        seen=DUCK_SEEN,
        versions=DUCK_VERSIONS,
    ),
)
def scd2_version_number(spark, sf):
    """One row per customer and attribute value, numbered by first sighting."""
    numbered = scd.number_versions(_versions(spark, sf))
    return numbered.select("customer_natural_key", "email_address", "device_id", "first_seen", "last_seen", "row_hash", "version_number")


MEMBERS = f"""SELECT CAST(k AS BIGINT) AS customer_key, n AS customer_natural_key, CAST(NULL AS VARCHAR) AS user_id_db, CAST(NULL AS VARCHAR) AS device_id,
  CAST(NULL AS VARCHAR) AS email_address, TIMESTAMP '1900-01-01' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, TRUE AS is_current, md5('') AS row_hash
FROM (VALUES (-1, 'UNKNOWN'), (-2, 'N/A')) m(k, n)"""


@query(
    "scd2_initial",
    duck(
        f"SELECT {SHOW} FROM history UNION ALL SELECT {SHOW} FROM members",
        seen=DUCK_SEEN,
        versions=DUCK_VERSIONS,
        history=DUCK_HISTORY.format(versions="versions"),
        members=MEMBERS,
    ),
)
def scd2_initial(spark, sf):
    """First load of the customer dimension."""
    hist = scd.initial_history(_versions(spark, sf))
    return with_unknown_members(hist, core.customer_members(hist))


DELTA = {
    "seen": DUCK_SEEN,
    "old_seen": OLD,
    "old_versions": VERSIONS.format(seen="old_seen"),
    "history": f"SELECT * FROM ({DUCK_HISTORY.format(versions='old_versions')}) UNION ALL {MEMBERS}",
    "versions": DUCK_VERSIONS,
    "latest": "SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY customer_natural_key ORDER BY first_seen DESC, email_address DESC NULLS LAST) = 1",
    "current_rows": "SELECT * FROM history WHERE is_current",
}
CHANGES = """SELECT s.*, e.customer_key AS old_key FROM {staged} s JOIN current_rows e USING (customer_natural_key) WHERE s.row_hash <> e.row_hash"""
FRESH = "SELECT s.* FROM {staged} s WHERE customer_natural_key NOT IN (SELECT customer_natural_key FROM current_rows)"
EXPIRED = f"""SELECT customer_key, customer_natural_key, user_id_db, device_id, email_address, valid_from, TIMESTAMP '{NOW}' AS valid_to, FALSE AS is_current, row_hash
FROM current_rows WHERE customer_natural_key IN (SELECT customer_natural_key FROM changes)"""
OPENED = f"""SELECT row_number() OVER (ORDER BY customer_natural_key, email_address NULLS FIRST) + (SELECT max(customer_key) FROM history){{more}} AS customer_key,
  customer_natural_key, user_id_db, device_id, email_address, TIMESTAMP '{NOW}' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, TRUE AS is_current, row_hash FROM {{source}}"""


def _delta(staged: str) -> dict[str, str]:
    return {
        **DELTA,
        "changes": CHANGES.format(staged=staged),
        "fresh": FRESH.format(staged=staged),
        "expired": EXPIRED,
        "opened": OPENED.format(more="", source="changes"),
        "inserted": OPENED.format(more=" + (SELECT count(*) FROM changes)", source="fresh"),
        "delta": "SELECT * FROM expired UNION ALL SELECT * FROM opened UNION ALL SELECT * FROM inserted",
    }


@query(
    "scd2_detect_change",
    duck("SELECT customer_natural_key, email_address, CAST(old_key AS BIGINT) AS old_key FROM changes", **_delta("latest")),
)
def scd2_detect_change(spark, sf):
    hist, versions = _history(spark, sf)
    changes = scd.detect_changes(hist, scd.latest_versions(versions))
    return changes.select("customer_natural_key", "email_address", "old_key")


@query("scd2_expire", duck(f"SELECT {SHOW} FROM expired", **_delta("latest")))
def scd2_expire(spark, sf):
    hist, versions = _history(spark, sf)
    return scd.expire_versions(hist, scd.detect_changes(hist, scd.latest_versions(versions)), _now())


@query("scd2_new_version", duck(f"SELECT {SHOW} FROM opened", **_delta("latest")))
def scd2_new_version(spark, sf):
    hist, versions = _history(spark, sf)
    return scd.new_versions(hist, scd.detect_changes(hist, scd.latest_versions(versions)), _now())


@query("scd2_new_keys", duck("SELECT customer_natural_key, email_address, row_hash FROM fresh", **_delta("latest")))
def scd2_new_keys(spark, sf):
    hist, versions = _history(spark, sf)
    return scd.unseen_keys(hist, scd.latest_versions(versions)).select("customer_natural_key", "email_address", "row_hash")


@query(
    "scd2_incremental",
    duck(
        f"""SELECT {SHOW} FROM (SELECT * FROM history WHERE customer_key NOT IN (SELECT customer_key FROM delta) UNION ALL SELECT * FROM delta)""",
        **_delta("latest"),
    ),
)
def scd2_incremental(spark, sf):
    """Merged history after an incremental run: one current row per customer."""
    hist, versions = _history(spark, sf)
    return scd.merge_history(hist, scd.history_delta(hist, versions, _now()))


@query(
    "scd2_incremental_every_version",
    duck(
        f"""SELECT {SHOW} FROM (SELECT * FROM history WHERE customer_key NOT IN (SELECT customer_key FROM delta) UNION ALL SELECT * FROM delta)""",
        **_delta("versions"),
    ),
)
def scd2_incremental_every_version(spark, sf):
    """The same run when every staged version is compared: old values open again."""
    hist, versions = _history(spark, sf)
    return scd.merge_history(hist, scd.history_delta(hist, versions, _now(), every_version=True))


@query(
    "join_current_version",
    duck(
        """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(coalesce(customer_key, -1) AS BIGINT) AS customer_key
        FROM orders LEFT JOIN current_rows ON customer_natural_key = CAST(o_custkey AS VARCHAR)""",
        **DELTA,
    ),
)
def join_current_version(spark, sf):
    """Orders joined to the current version of their customer only."""
    hist, _ = _history(spark, sf)
    now = scd.current_rows(hist).select("customer_natural_key", "customer_key")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer_natural_key"))
    joined = orders.join(now, "customer_natural_key", "left")
    return joined.select("o_orderkey", F.coalesce("customer_key", F.lit(-1)).alias("customer_key"))


@query(
    "check_one_current",
    duck(
        """SELECT customer_natural_key, CAST(count(*) FILTER (is_current) AS BIGINT) AS current_count
        FROM (SELECT * FROM history WHERE customer_key NOT IN (SELECT customer_key FROM delta) UNION ALL SELECT * FROM delta)
        GROUP BY 1 HAVING count(*) FILTER (is_current) <> 1""",
        **_delta("versions"),
    ),
)
def check_one_current(spark, sf):
    """Customers with several current rows after comparing every version."""
    from orderloom.operators.checks import not_exactly_one_current

    hist, versions = _history(spark, sf)
    return not_exactly_one_current(scd.merge_history(hist, scd.history_delta(hist, versions, _now(), every_version=True)))


@query(
    "check_valid_ranges",
    duck(
        f"""SELECT {SHOW} FROM (SELECT * FROM history UNION ALL SELECT customer_key, customer_natural_key, user_id_db, device_id, email_address,
          TIMESTAMP '{NOW}', valid_from, FALSE, row_hash FROM current_rows) WHERE valid_to < valid_from""",
        **DELTA,
    ),
)
def check_valid_ranges(spark, sf):
    """Versions that end before they start (planted ones)."""
    from orderloom.operators.checks import inverted_ranges

    hist, _ = _history(spark, sf)
    wrong = scd.current_rows(hist).withColumns({"valid_to": F.col("valid_from"), "valid_from": _now(), "is_current": F.lit(False)})
    return inverted_ranges(hist.unionByName(wrong))


MONTH_TOTALS = """SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, store_id, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(usd_cents) AS BIGINT) AS cents FROM sales GROUP BY 1, 2"""


def _month_totals(rows):
    return rows.groupBy(F.trunc("order_date", "month").alias("order_month"), "store_id").agg(
        F.count("*").alias("n"), F.sum("usd_cents").alias("cents")
    )


def _before(column: str, day: str):
    return F.col(column) < F.lit(day).cast("date")


@query(
    "incremental_high_watermark",
    duck(
        "SELECT order_date, CAST(count(*) AS BIGINT) AS n FROM sales WHERE order_date > (SELECT max(order_date) FROM sales WHERE order_date < DATE '1999-01-01') GROUP BY 1",
        "sales",
    ),
)
def incremental_high_watermark(spark, sf):
    sales = view(spark, sf, "sales")
    loaded = sales.where(_before("order_date", "1999-01-01"))
    return incremental.newer_rows(sales, loaded).groupBy("order_date").agg(F.count("*").alias("n"))


@query(
    "incremental_insert_overwrite",
    duck(
        """SELECT order_month, store_id, CASE WHEN order_month >= DATE '1998-10-01' THEN n * 10 ELSE n END AS n, cents FROM totals""",
        "sales",
        totals=MONTH_TOTALS,
    ),
)
def incremental_insert_overwrite(spark, sf):
    """Rewritten partitions replace the stored ones; the others stay."""
    path = scratch(spark) + "/monthly"
    totals = _month_totals(view(spark, sf, "sales"))
    incremental.overwrite_days(totals.where(_before("order_month", "2000-01-01")), path, "order_month", ["store_id"])
    fresh = totals.where(~_before("order_month", "1998-10-01")).withColumn("n", F.col("n") * 10)
    incremental.overwrite_days(fresh, path, "order_month", ["store_id"])
    return spark.read.parquet(path).select("order_month", "store_id", "n", "cents")


@query("incremental_full_refresh", duck("SELECT * FROM totals", "sales", totals=MONTH_TOTALS))
def incremental_full_refresh(spark, sf):
    """First run, incremental run and full refresh end in the same table."""
    path = scratch(spark) + "/monthly"
    sales = view(spark, sf, "sales")

    def build_from(rows):
        def build(mark):
            totals = _month_totals(rows)
            return totals if mark is None else totals.where(F.col("order_month") > mark)

        return build

    incremental.run_incremental(spark, path, build_from(sales.where(_before("order_date", "1999-05-01"))), "order_month")
    incremental.run_incremental(spark, path, build_from(sales), "order_month")
    twice = spark.read.parquet(path).select("order_month", "store_id", "n", "cents")
    again = scratch(spark) + "/monthly"
    incremental.run_incremental(spark, again, build_from(sales), "order_month", full_refresh=True)
    return spark.read.parquet(again).select("order_month", "store_id", "n", "cents").intersectAll(twice)


@query(
    "append_new_columns",
    duck(
        """SELECT order_date, CAST(NULL AS BIGINT) AS units, CAST(count(*) AS BIGINT) AS n FROM sales WHERE order_date < DATE '1998-01-01' GROUP BY 1
        UNION ALL SELECT order_date, CAST(sum(quantity) AS BIGINT), CAST(count(*) AS BIGINT) FROM sales WHERE order_date >= DATE '1998-01-01' GROUP BY 1""",
        "sales",
    ),
)
def append_new_columns(spark, sf):
    """A later load brings a new column; older rows have NULL there."""
    sales = view(spark, sf, "sales")
    split = F.lit("1998-01-01").cast("date")
    old = sales.where(F.col("order_date") < split).groupBy("order_date").agg(F.count("*").alias("n"))
    new = sales.where(F.col("order_date") >= split).groupBy("order_date").agg(F.count("*").alias("n"), F.sum("quantity").alias("units"))
    return incremental.append_columns(old, new)
