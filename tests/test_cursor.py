"""Cursor reads: every row once, whatever stops a run."""

import random

import pytest

from orderloom.session import scratch_path
from orderloom.streaming import cursor

SCHEMA = "k long, v string"


def _write(spark, path, keys):
    spark.createDataFrame([(k, f"v{k}") for k in keys], SCHEMA).repartition(3).write.mode("append").parquet(path)


def test_next_keys_and_rows(spark):
    path = scratch_path(spark).removeprefix("file:")
    keys = random.Random(1).sample(range(1000), 100)
    _write(spark, path, keys)
    c = cursor.ParquetCollection(path, "k", ("v", "k"))
    ordered = sorted(keys)
    assert c.next_keys(None, 30, 3) == [ordered[9], ordered[19], ordered[29]]
    assert c.next_keys(ordered[29], 500, 2) == [ordered[64], ordered[99]]
    assert c.next_keys(ordered[-2], 5, 4) == [ordered[-1]] and c.next_keys(ordered[-1], 5, 4) == []
    got = [r for b in c.rows(ordered[4], ordered[8]) for r in b.to_pylist()]
    assert sorted(r["k"] for r in got) == ordered[5:9] and list(got[0]) == ["v", "k"]


def test_stopped_runs_go_on_and_later_rows_follow(spark):
    path, base = scratch_path(spark).removeprefix("file:"), scratch_path(spark)
    _write(spark, path, range(0, 95))
    stream = cursor.read_cursor(spark, cursor.ParquetCollection(path, "k", ("k", "v")), SCHEMA, rows_per_batch=20, ranges=3, name="stopped_cursor")

    def run(most=None):
        n = cursor.drain(stream, f"{base}/out", f"{base}/checkpoint", most)
        return n, sorted(r.k for r in spark.read.parquet(f"{base}/out").collect())

    assert run(2) == (2, list(range(40)))
    assert run(1) == (1, list(range(60)))
    assert run() == (2, list(range(95)))
    assert run() == (0, list(range(95)))
    _write(spark, path, range(95, 130))
    assert run() == (2, list(range(130)))


def test_a_failing_batch_is_read_again(spark):
    path, base = scratch_path(spark).removeprefix("file:"), scratch_path(spark)
    _write(spark, path, range(50))
    stream = cursor.read_cursor(spark, cursor.ParquetCollection(path, "k", ("k", "v")), SCHEMA, rows_per_batch=25, name="failing_cursor")
    seen = []

    def broken(batch, number):
        seen.append(number)
        if number == 1:
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{base}/checkpoint").start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    assert seen == [0, 1] and cursor.drain(stream, f"{base}/out", f"{base}/checkpoint") == 1
    assert sorted(r.k for r in spark.read.parquet(f"{base}/out").collect()) == list(range(50))
