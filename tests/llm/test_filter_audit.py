"""Every order of filters, against a direct count."""

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from llm.conftest import docs_frame, sentence
from orderloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, good, toxic):
    """{(part, order, step): figures} with every row tested in every order."""
    tested = []
    for id_, text, part in rows:
        text, part = text or "", part or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": id_ is not None and any(i is not None and i < id_ and (t or "") == text for i, t, _ in rows),
        }
        tested.append((part, {k for k, v in fails.items() if v}, id_ in good, id_ in toxic))
    out, orders = {}, ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {r[0] for r in tested}:
        mine = [r for r in tested if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = mine
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[name] += len(gone)
                failing = sum(name in r[1] for r in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(r[1] == {name} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for order in orders:
            for step, name in enumerate(order, 1):
                out[part, order, step].append(shapley[name])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    got = {(r[0], r[1], r[2]): tuple(r)[3:] for r in df.collect()}
    assert len(got) == df.count()
    return got


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, part string, mask int")


def test_odd_rows_against_brute_force(spark, odd_rows):
    import random

    rng = random.Random(2)
    rows = [(i, t, rng.choice([None, "", "a", "b", "part"])) for i, t in odd_rows]
    rows += [(200 + i, rng.choice(["SHOUT " * 60, "# " + sentence(rng, 80), sentence(rng, 10), sentence(rng, 70), None]), rng.choice("abc")) for i in range(150)]
    docs = docs_frame(spark, [(i, t, "en", s) for i, t, s in rows])
    marks = [(i, rng.randrange(2), rng.randrange(2), "x", "y", 3) for i, _, _ in rows[::2]] + [(None, 1, 1, "x", "y", 3), (9999, 1, 1, "x", "y", 3), (3, None, 1, "x", "y", 3), (3, 0, None, "x", "y", 3)]
    good = {m[0] for m in marks if m[1] == 1} - {None}
    toxic = {m[0] for m in marks if m[2] == 1} - {None}
    assert found(filter_audit.audit(docs, labels_frame(spark, marks))) == brute(rows, good, toxic)


def test_empty_tables(spark):
    docs, none = docs_frame(spark, []), labels_frame(spark, [])
    assert filter_audit.audit(docs, none).count() == 0
    one = filter_audit.audit(docs_frame(spark, [(1, None, "en", None)]), none)
    assert one.count() == 600 and one.where("part <> ''").count() == 0


def test_hot_text_and_part(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"), F.lit("one").alias("source")
    )
    got = filter_audit.audit(docs, labels_frame(spark, [])).where("filter_order = 'EABCD' and step = 1").first()
    assert (got.removed, got.kept, got.unique_fails) == (999, 2001, 0)


def test_other_filters_and_flags(spark):
    docs = docs_frame(spark, [(1, "a b", "en", "s"), (2, "c", "en", "s")])
    filters = {"x": lambda text, words: F.size(words) < 2, "y": lambda text, words: text.contains("a")}
    got = filter_audit.audit(docs, labels_frame(spark, [(2, 5, 0, "", "", 0)]), filters, {"five": F.col("quality") == 5})
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "five_lost", "shapley"]
    assert sorted(tuple(r)[1:] for r in got.collect()) == [("xy", 1, 1, 1, 0, 1, 1, 2), ("xy", 2, 0, 1, 0, 1, 0, 2), ("yx", 1, 1, 1, 0, 1, 0, 2), ("yx", 2, 0, 1, 0, 1, 1, 2)]
    with pytest.raises(ValueError, match="one letter"):
        filter_audit.audit(docs, docs, {"long": filters["x"]})


@pytest.mark.parametrize("n", range(6))
def test_plain_changes_visit_every_order(n):
    order = list(range(n))
    seen = {tuple(order)}
    for i in filter_audit.plain_changes(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n)


def test_exchange_keeps_equal_nodes_once():
    diagram = filter_audit.Diagram({m: (1,) for m in range(32)}, 5, 1)
    for place in filter_audit.plain_changes(5):
        diagram.exchange(place)
        assert [len(level) for level in diagram.levels] == [1] * 6 and diagram.weight[diagram.root] == (32,)
