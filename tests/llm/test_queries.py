"""The registered queries: schemas, and answers on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from orderloom.llm import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    2: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    3: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    4: {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    5: {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    6: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    7: {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    8: {"doc_id": "bigint", "item_id": "bigint"},
    9: {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    10: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    11: {"part": "string", "filter_order": "string", "step": "int", **{c: "bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}},
    12: {"lang": "string", "phrase": "string", **{c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")}},
    13: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_contract_columns(spark, number):
    (name,) = [n for n in queries.QUERIES if n.startswith(f"op{number}_")]
    out = queries.QUERIES[name](spark, DATA)
    types = dict(out.dtypes)
    assert {c: types.get(c) for c in COLUMNS[number]} == COLUMNS[number]
    table = "pages" if "page_id" in types else "documents"
    if number == 11:
        assert out.count() == 600 * spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("coalesce(source, '') AS part").distinct().count()
    elif number not in (8, 12):
        assert out.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


def test_registered_with_the_rest():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names) and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("left", [(), ("orderloom/llm/__pycache__/x.pyc", "corpus_pipeline.py")])
def test_the_rest_works_without_the_folders(tmp_path, left):
    root = Path(entry.__file__).parent
    for name in ("__spark_entry__.py", "orderloom"):
        source = root / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path)
    for name in left:  # what a deletion may leave behind
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("from orderloom.llm import mixing\n")
    code = (
        "import __spark_entry__ as e, sys; assert not any(n.startswith('op') and n[2:3].isdigit() for n in e.queries())\n"
        "assert not any(m.startswith('orderloom.llm.') for m in sys.modules); print(len(e.queries()), len(e.oracle_sql()))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and int(out.stdout.split()[0]) > 100, out.stderr
