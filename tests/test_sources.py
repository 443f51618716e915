"""Files in and out, routing, streaming."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from orderloom.sources import exports, jsonl, routing, schemas
from orderloom.streaming import autoload as a


def _gz(path, docs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n")


def test_layouts():
    assert [len(schemas.TABLES[t]) for t in ("events", "products", "ip_locations")] == [33, 42, 5]


def test_globs():
    assert routing.raw_glob("b", "events", "20260404") == "b/raw/events/events_20260404_part*.jsonl.gz"
    assert routing.raw_glob("b", "events") == "b/raw/events/*.json*.gz"
    assert routing.raw_glob("b", "products", "20260404") == "b/raw/products/products_20260404.jsonl.gz"
    with pytest.raises(ValueError):
        routing.raw_glob("b", "orders")


def test_routes(spark):
    paths = ["raw/events/x", "raw/ip_locations/x", "raw/products/x", "other/raw/events/x", "RAW/events/x", ""]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select(routing.table_of_path("path").alias("t"))
    assert [r.t for r in df.collect()] == ["events", "ip_locations", "products", None, None, None]


def test_mixed_event_types(spark):
    doc = {
        "_id": "a", "collection": "x", "store_id": 6, "utm_source": True, "order_id": 1.5, "time_stamp": "15",
        "option": {"alloy": "gold"}, "key_search": {"z": 1},
        "cart_products": [{"product_id": 103324, "amount": "2", "option": ""},
                          {"product_id": "7", "option": [{"option_id": 261151, "option_label": "diamond", "value_id": 2166253}]}],
    }
    lines = spark.createDataFrame([(json.dumps(doc),), ("   ",)], "line string")
    row = jsonl.load_events(lines).first()
    assert (row.store_id, row.utm_source, row.order_id, row.time_stamp, row.key_search) == ("6", "true", "1.5", 15, None)
    assert (row.user_id_db, row.email_address, row.device_id) == ("", "", None)
    assert [o.value_label for o in row.option] == ["gold"]
    assert [(c.product_id, c.amount, len(c.option)) for c in row.cart_products] == [(103324, 2, 0), (7, None, 1)]
    assert row.cart_products[1].option[0].option_id == 261151
    assert jsonl.load_events(lines, normalise_options=False).first().option == []


def test_strict_and_permissive(spark):
    lines = spark.createDataFrame([("{broken",), ('{"_id":"a","time_stamp":"x"}',)], "line string")
    with pytest.raises(Exception):
        jsonl.load_events(lines).collect()
    assert jsonl.load_events(lines, strict=False).count() == 2
    assert [r.line for r in jsonl.rejected_lines(lines).collect()] == ["{broken"]


def test_export_parts_and_stats(spark, tmp_path):
    df = spark.createDataFrame([(i, "é") for i in range(25)], "id int, t string").coalesce(1)
    path = str(tmp_path / "out")
    exports.export_parts(df, path, rows_per_part=10)
    files = [f for f in os.listdir(path) if f.endswith(".gz")]
    assert len(files) == 3
    stats = exports.export_stats(df, path).first()
    expected = sum(len(json.dumps({"id": i, "t": "é"}, ensure_ascii=False, separators=(",", ":")).encode()) + 1 for i in range(25))
    assert (stats.records, stats.uncompressed_bytes) == (25, expected)
    assert stats.compressed_bytes == sum(os.path.getsize(os.path.join(path, f)) for f in files)
    empty = exports.export_stats(df.limit(0)).first()
    assert (empty.records, empty.uncompressed_bytes) == (0, 0)
    with pytest.raises(ValueError):
        exports.of_types(df, "t", [])


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "status": "success"}, {"id": 2, "status": "error"}]))
    rows = jsonl.json_array_to_lines(spark, str(tmp_path / "a.json"), "id int, status string", jsonl.field_equals("status", "success"))
    assert [r.id for r in rows.collect()] == [1]


def test_autoload_loads_every_file_once(spark, tmp_path):
    root, target, marks = (str(tmp_path / n) for n in ("bucket", "tables", "marks"))
    _gz(f"{root}/raw/events/events_20240101_part1.jsonl.gz", [{"_id": "1", "collection": "c", "time_stamp": 1}, ""])
    _gz(f"{root}/raw/ip_locations/ip_locations_20240101.jsonl.gz", [{"ip": "1.1.1.1", "country": "DE"}])
    _gz(f"{root}/else/events_20240101_part9.jsonl.gz", [{"_id": "9"}])

    def load():
        for q in a.autoload(spark, root, target, marks):
            q.awaitTermination()

    load()
    _gz(f"{root}/raw/events/events_20240102_part1.jsonl.gz", [{"_id": "2", "collection": "c", "time_stamp": 2}])
    load()
    load()
    assert sorted(r._id for r in a.loaded_table(spark, target, "events").collect()) == ["1", "2"]
    assert [r.country for r in a.loaded_table(spark, target, "ip_locations").collect()] == ["DE"]
    batch = jsonl.load_events(jsonl.read_lines(spark, f"{root}/raw/events/*.gz"), loaded_at=F.lit(None).cast("timestamp"))
    streamed = a.loaded_table(spark, target, "events").drop("ingested_at")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.drop("ingested_at").collect()))


def test_exported_parts_are_loaded_and_a_new_checkpoint_loses_nothing(spark, tmp_path):
    root, target = str(tmp_path / "bucket"), str(tmp_path / "raw")
    ips = spark.createDataFrame([(f"1.1.1.{i}", "c") for i in range(25)], "ip string, country_short string")
    exports.export_parts(ips, f"{root}/raw/ip_locations", rows_per_part=10)
    for marks, start in (("one", 25), ("two", 50)):
        for q in a.autoload(spark, root, target, str(tmp_path / marks)):
            q.awaitTermination()
            assert q.exception() is None
        assert a.loaded_table(spark, target, "ip_locations").count() == start
    for q in a.autoload(spark, root, target, str(tmp_path / "two")):
        q.awaitTermination()
    assert a.loaded_table(spark, target, "ip_locations").count() == 50


def test_bad_lines_are_set_aside_by_the_stream(spark, tmp_path):
    root, target = str(tmp_path / "bucket"), str(tmp_path / "raw")
    _gz(f"{root}/raw/ip_locations/ip_locations_20260101.jsonl.gz", [{"ip": "1.1.1.1"}, "{broken", "[1]", "", {"ip": "1.1.1.2"}])
    for q in a.autoload(spark, root, target, str(tmp_path / "marks"), quarantine=True):
        q.awaitTermination()
        assert q.exception() is None
    assert a.loaded_table(spark, target, "ip_locations").count() == 2
    assert sorted(r.line for r in a.rejected_table(spark, target, "ip_locations").collect()) == ["[1]", "{broken"]


def test_required_columns(spark):
    df = spark.createDataFrame([("1.1.1.1", None), (None, None)], "ip string, ingested_at timestamp")
    assert {r.column_name: r.missing for r in schemas.missing_required(df, "ip_locations").collect()} == {"ip": 1, "ingested_at": 2}


def test_rejected_lines_are_told_without_the_schema_of_documents(spark):
    lines = spark.createDataFrame([(t,) for t in (
        '{"_id":"a"}', ' \t{"_id":"b"} ', '[{"_id":"c"}]', '{"_id":"d"', '"{}"', "7", "null", "  ", None, "{}", '{"_id":1,"_id":2}',
    )], "line string")
    good, bad = jsonl.split_rejected(lines)
    assert {r.line for r in good.collect()} == {'{"_id":"a"}', ' \t{"_id":"b"} ', "{}", '{"_id":1,"_id":2}'}
    assert {r.line for r in bad.collect()} == {'[{"_id":"c"}]', '{"_id":"d"', '"{}"', "7", "null"}
    assert "schema_of_variant" not in good._jdf.queryExecution().optimizedPlan().toString()
