"""Streaming loads, run to completion over the files that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.registry import query, scratch
from orderloom.catalog.standins import duck, table, view
from orderloom.streaming import autoload as a, cursor


@query(
    "stream_autoload",
    duck(
        """SELECT 'events' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT _id) AS BIGINT) AS distinct_keys FROM ev
        UNION ALL SELECT 'ip_locations', CAST(count(*) AS BIGINT), CAST(count(DISTINCT ip) AS BIGINT) FROM geo""",
        "ev",
        "geo",
    ),
)
def stream_autoload(spark, sf):
    """Files that arrive in two waves are loaded exactly once; files outside raw/ are ignored."""
    root, target, marks = (f"{scratch(spark)}/{n}" for n in ("bucket", "tables", "checkpoint"))
    jsonl = view(spark, sf, "jsonl").select("line", "event_id")
    geo = view(spark, sf, "geo").select(F.to_json(F.struct("ip", "country", "region", "city")).alias("line"))

    def write(lines, folder):
        lines.write.mode("append").option("compression", "gzip").text(f"{root}/{folder}")

    def load():
        for q in a.autoload(spark, root, target, marks, pattern="*.gz"):
            q.awaitTermination()

    write(jsonl.where(F.col("event_id") % 2 == 0).select("line"), "raw/events")
    write(geo, "raw/ip_locations")
    write(geo, "other")
    load()
    write(jsonl.where(F.col("event_id") % 2 == 1).select("line"), "raw/events")
    load()
    out = None
    for table, key in (("events", "_id"), ("ip_locations", "ip")):
        rows = a.loaded_table(spark, target, table)
        one = rows.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("distinct_keys"))
        one = one.select(F.lit(table).alias("table_name"), "row_count", "distinct_keys")
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_dedup", duck("SELECT collection, CAST(count(DISTINCT _id) AS BIGINT) AS events FROM ev_dup GROUP BY 1", "ev_dup"))
def stream_dedup(spark, sf):
    """Re-delivered events are dropped while they stream."""
    base = scratch(spark)
    rows = view(spark, sf, "ev_dup").select("_id", "collection", F.timestamp_seconds("time_stamp").alias("event_time"))
    rows.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    unique = a.drop_redelivered(stream, "_id", "event_time", "60 days")
    q = (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("collection").agg(F.count("*").alias("events"))


@query(
    "cursor_read_with_resume",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS event_rows, CAST(count(DISTINCT event_id) AS BIGINT) AS events, CAST(sum(user_id) AS BIGINT) AS user_sum
    FROM events GROUP BY 1""",
)
def cursor_read_with_resume(spark, sf):
    """All events by key in nine or ten batches; the run is stopped after three and goes on where it was."""
    base, rows = scratch(spark), table(spark, sf, "events")
    events = cursor.ParquetCollection(f"{sf}/events.parquet", "event_id", ("event_id", "user_id", "event_type"))
    size = -(-rows.count() // 9)
    stream = cursor.read_cursor(spark, events, "event_id long, user_id long, event_type string", size, ranges=4)
    cursor.drain(stream, f"{base}/out", f"{base}/checkpoint", most_batches=3)
    cursor.drain(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(
        F.count("*").alias("event_rows"), F.count_distinct("event_id").alias("events"), F.sum("user_id").alias("user_sum")
    )
