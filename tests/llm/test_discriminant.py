"""Quadratic discriminant: held-out accuracy, statistics and densities against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import docs_frame
from orderloom.llm import discriminant as d
from orderloom.llm.texthash import word_chunks

DATA = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int, text string, x int, score string"


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    out, model = d.judge(docs, labels)
    return docs, labels, out.persist(), model


def test_held_out_accuracy(judged):
    docs, labels, out, _ = judged
    rows = out.join(labels, "doc_id").where("held_out")
    share = {r["quality"]: (r["n"], r["right"]) for r in rows.groupBy("quality").agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right")).collect()}
    assert share[0][0] > 100 and share[0][1] > 0.97 and share[1][0] > 700 and share[1][1] > 0.99
    assert out.count() == docs.count() and out.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_held_out_rows_are_by_crc(judged):
    for r in judged[2].limit(300).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_nothing_but_the_text_counts(spark, judged):
    docs, labels, _, model = judged
    some = docs.limit(200)
    a = d.scored(d.with_statistics(some), model).drop("x").collect()
    other = some.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(3).alias("x"))
    assert a == d.scored(d.with_statistics(other), model).drop("x").collect()


def test_held_out_labels_are_not_learned(spark, judged):
    docs, labels, _, model = judged
    changed = labels.withColumn("quality", F.when(d.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = d.judge(docs, changed)[1]
    assert np.allclose(again.good.mean, model.good.mean, atol=1e-9) and np.allclose(again.bad.whitener, model.bad.whitener, rtol=1e-6)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    text, n, c = text or "", len(words), d.USUAL_WORDS
    lengths, u = [len(w) for w in words], d.USUAL
    mean = (sum(lengths) + c * u["word_length"]) / (n + c)
    spread = math.sqrt((sum(x * x for x in lengths) + c * (u["word_length"] ** 2 + u["word_spread"] ** 2)) / (n + c) - mean**2)
    grams = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    again = sum(v - 1 for v in grams.values())

    def odds(kind, part, whole, more=c):
        return math.log((part + u[kind] * more) / (whole - part + (1 - u[kind]) * more))

    kinds = {"upper": r"[A-Z]", "digits": "[0-9]", "marks": "[.,;:!?]", "symbols": r"[#*$%&|<>{}\[\]~^_=+\\/@]"}
    return [
        math.log(max(n, d.LEAST_LENGTH)), math.log(mean), math.log1p(spread), odds("distinct", len(set(words)), n), odds("top_word", max(Counter(words).values(), default=0), n),
        odds("repeats", again, max(n - 2, 0)), *[odds(k, len(re.findall(p, text)), len(text), 10 * c) for k, p in kinds.items()], math.log((n + c) / (text.count("\n") + 2)),
    ]


def test_statistics_against_plain_python(spark, odd_rows):
    docs = docs_frame(spark, odd_rows)
    got = d.with_statistics(docs.withColumn("doc_id", F.monotonically_increasing_id())).join(docs.withColumn("id", F.monotonically_increasing_id()).select("id", "text"), "id").collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert np.allclose(r.x, plain(r.text), atol=1e-9), r.text


def test_statistics_do_not_depend_on_chunks():
    texts = ["one two three one two three", "", "A\nB\nA\nB !!", "é" * 10]
    whole = next(iter(word_chunks(pa.array(texts))))
    edges = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for i, row in enumerate(d.statistics(whole, edges)):
        alone = next(iter(word_chunks(pa.array([texts[i]]))), None)
        if alone is not None:
            assert np.allclose(row, d.statistics(alone, np.array([0, len(texts[i].encode())]))[0])


def test_scores_are_the_density_ratio():
    rng = np.random.default_rng(3)
    p = len(d.FEATURES)
    root = rng.normal(size=(2, p, p))
    covariance = [r @ r.T + np.eye(p) for r in root]
    means = rng.normal(size=(2, p))
    model = d.Discriminant(d.Gaussian.of(0.2, means[0], covariance[0]), d.Gaussian.of(0.8, means[1], covariance[1]), 0.8)
    x = rng.normal(size=(50, p))

    def density(k, share):
        away = x - means[k]
        far = np.einsum("ni,ij,nj->n", away, np.linalg.inv(covariance[k]), away)
        return share * np.exp(-0.5 * far) / np.sqrt(np.linalg.det(covariance[k]))

    want = density(1, 0.8) / (density(0, 0.2) + density(1, 0.8))
    assert np.allclose(model.scores(x), want, atol=1e-8)


def test_fit_takes_all_rows_of_both_classes(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(60, len(d.FEATURES))), [0] * 25 + [1] * 35
    model = d.fit(spark.createDataFrame([(r.tolist(), k) for r, k in zip(x, y, strict=True)] + [(x[0].tolist(), 7), (x[1].tolist(), None)], "x array<double>, label int"))
    good, bad = x[25:], x[:25]
    own = [np.cov(c.T, bias=True) for c in (bad, good)]
    pooled = (25 * own[0] + 35 * own[1]) / 60
    assert np.allclose(model.good.mean, good.mean(axis=0)) and model.share == 35 / 60
    back = np.linalg.inv(model.bad.whitener)
    assert np.allclose(back @ back.T, d.shrunk(own[0], pooled))


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(1, 0), (2, 1), (3, 1)], 2 / 3)])
def test_too_few_labels(spark, labels, score):
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = docs_frame(spark, [(i, f"text {i}") for i in ids] + [(None, None)])
    known = spark.createDataFrame([(ids[i], q, 0, "t", 1, "s") for i, q in labels], LABELS)
    out, _ = d.judge(docs, known)
    assert {round(r.score, 9) for r in out.collect()} == {round(score, 9)} and out.count() == len(ids) + 1


def test_odd_rows_and_labels(spark, odd_rows):
    docs = docs_frame(spark, odd_rows)
    marks = [(i, int(i % 3 > 0), 0, "t", 1, "s") for i, _ in odd_rows if i is not None] + [(None, 1, 0, "t", 1, "s"), (7777, 0, 0, "t", 1, "s"), (5, None, 0, "t", 1, "s"), (5, 0, 0, "t", 1, "s")]
    out, _ = d.judge(docs, spark.createDataFrame(marks, LABELS))
    rows = out.collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert d.judge(docs_frame(spark, []), spark.createDataFrame(marks, LABELS))[0].count() == 0
    same = out.join(docs, "doc_id").where("text is null or text = ''").select("score").distinct()
    assert same.count() == 1
