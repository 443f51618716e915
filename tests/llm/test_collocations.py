"""Phrases of a corpus against a direct count of all of them."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import docs_frame
from orderloom.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, dropped_at=80):
    counts = {}
    for _, text, lang in rows:
        of = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                of.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, of in counts.items():
        n = sum(v for k, v in of.items() if len(k) == 1)
        often = {k: v for k, v in of.items() if len(k) > 1 and v >= least}
        longest = {}
        for phrase, a in often.items():
            for m in range(2, len(phrase)):
                for i in range(len(phrase) - m + 1):
                    part = phrase[i : i + m]
                    longest[part] = max(longest.get(part, 0), a)
        kept = []
        for phrase, a in often.items():
            if 100 * longest.get(phrase, 0) >= dropped_at * a:
                continue
            cuts = [(2_000_000 * a // (of[phrase[:k]] + of[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), of[phrase[:k]], of[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n=120):
    """Words of very different frequency, fixed phrases of 2 to 6 words, marks, tabs, odd characters."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "ß😀", "A", "B", "a-b", "x" * 300]
    fixed = [["New", "York"], ["in", "the", "same", "way"], ["one", "two", "three"], ["lic", "ense", "of", "this", "work", "is"], ["É", "日本"], ["New", "York", "Times"]]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(80)):
            parts += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(words[: rng.choice([4, 12, 46])])]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " \r\n"]) for p in parts)
        rows.append((i, text, rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize(("least", "top", "batch"), [(5, 30, 2), (5, 8, 1), (3, 10_000, 2), (30, 2000, 2)])
def test_against_brute_force(spark, least, top, batch):
    rows = [*corpus(least + top), (None, None, "en"), (1, "", "xx"), (2, " .,\n", "yy"), (3, "alone", "zz"), (4, "a b " * 3000, "zz"), (4, "a b " * 3000, "zz")]
    got = collocations.collocations(docs_frame(spark, rows), least=least, top=top, first_batch=batch)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top)


def test_deeper_batches_and_full_table(spark):
    rows = corpus(77, 150)
    want = brute(rows, 4, 60)
    docs = docs_frame(spark, rows)
    # a first batch that does not settle the languages, and a table so small that nearly every phrase passes it
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=4, top=60, first_batch=1).collect()) == want
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=4, top=60, table_bits=7).collect()) == want


def test_longer_phrase_with_an_uncounted_part(spark):
    """`x1 the one the` drops `x1 the one`, though no bound asks for `the one the`."""
    rng = random.Random(4)
    parts = [f"x{i % 3} the one{i % 3} the y{rng.randrange(40)}" for i in range(60)] + [f"the of{rng.randrange(30)}" for _ in range(900)]
    parts += [f"u{i} v{i}" for i in range(12) for _ in range(12)]
    rng.shuffle(parts)
    rows = [(i, part + ".", "en") for i, part in enumerate(parts)]
    want = brute(rows, 5, 6)
    assert sorted(tuple(r) for r in collocations.collocations(docs_frame(spark, rows), least=5, top=6, first_batch=1).collect()) == want


def test_empty_table(spark):
    got = collocations.collocations(docs_frame(spark, []))
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_ties_are_ordered_by_bytes(spark):
    rows = [(i, f"{w}1 {w}2.", "en") for i in range(40) for w in ("é", "z", "a", "日", "😀", "ﬀ")]
    got = [r.phrase for r in collocations.collocations(docs_frame(spark, rows), top=4).orderBy("rank").collect()]
    assert got == [f"{w}1 {w}2" for w in ("a", "z", "é", "日")]


def test_score_passes_64_bits(spark):
    a, l, r = 9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 9_200_000_000_000_000_000  # noqa: E741
    pairs = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, a long")
    words = spark.createDataFrame([("en", "x", l), ("en", "y", r)], "lang string, phrase string, a long")
    assert collocations.scored(pairs, words, 2).first().score == 2_000_000 * a // (l + r)


@pytest.mark.parametrize("size", [1, 7, 64, 10**6])
def test_chunks_lose_nothing(size):
    texts = [t for _, t, _ in corpus(3, 20)] + [None, "", "no mark in here " * 20, "end."]
    got = Counter()
    for chunk in collocations.chunks(pa.array(texts), size):
        for i in range(len(chunk.starts)):
            got[chunk.rows[i], bytes(chunk.data[chunk.starts[i] : chunk.ends[i + chunk.room[i] - 1]])] += 1
    want = Counter()
    for row, text in enumerate(texts):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update((row, " ".join(words[i:]).encode()) for i in range(len(words)))
    assert got == want


def test_bound_holds(spark):
    """No phrase scores above the bound of a phrase that it begins or ends with."""
    rows = corpus(9)
    docs = docs_frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = collocations.counted(docs, 1, None, 3).where("phrase is not null")
    all_pass = words.select("lang", "phrase", F.lit(True).alias("right"), F.lit(True).alias("left"))
    pairs = collocations.counted(docs, 2, collocations.table_of(all_pass, 1, 20), 3)
    two = collocations.scored(pairs, words, 2)
    three = collocations.counted(docs, 3, collocations.table_of(two.select("lang", "phrase", F.lit(True).alias("right"), F.lit(True).alias("left")), 2, 20), 3)
    got = collocations.scored(three, words.unionByName(pairs), 3).withColumn("head", F.substring_index("phrase", " ", 2)).withColumn("tail", F.substring_index("phrase", " ", -2))
    right, left = (two.select("lang", F.col("phrase").alias(c), F.col(b).alias("most_" + b)) for c, b in (("head", "right"), ("tail", "left")))
    both = got.join(right, ["lang", "head"]).join(left, ["lang", "tail"])
    assert both.count() > 50 and both.where("score > most_right or score > most_left or right > most_right or left > most_left").count() == 0
