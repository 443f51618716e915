"""Benchmark decontamination with spaced seeds.

A seed is a mask such as 1101100101011: words at the 1s are hashed, words at the 0s may differ. Every position of every
document and of every benchmark item is hashed under each mask, and equal hashes are hits. A hit fixes how the document
and the item lie against each other; there the two are compared word by word, and the best segment, in which a
different word costs as much as three equal ones gain, is an overlap if it is long enough. So a copied passage is found
although single words in it were replaced.

All of it is built-in expressions. Items with equal words are one item until the end, known by a digest of the words,
so a null or repeated id loses nothing. Seeds are exploded and probed inside one generated stage, so positions are never
shuffled; what is shuffled is one row per document, item and alignment that has a hit. Beyond a number of benchmark
seeds the positions are shuffled after all, as key, place and seed only; the words of documents with hits are joined later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import KEY, row_key
from orderloom.session import stored

MASKS = ("1110110101", "110100101111", "1011011100011")
MIN_WORDS, PENALTY, SHORTEST = 12, 3, 4
#: Seeds of the benchmark up to this number are sent to all executors; more are joined by a shuffle.
BROADCAST_SEEDS = 500_000


def words(text: Column) -> Column:
    """Hashes of the words: lower case, without anything but letters and digits; null for null."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]+", "")
    return F.transform(F.filter(F.split(plain, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, at: Column, size: Column, masks: Sequence[str]) -> Column:
    """One hash per mask for the words at `at`; null where the mask does not fit."""
    out = []
    for number, mask in enumerate(masks):
        kept = [F.get(hashes, at + F.lit(i)) for i, c in enumerate(mask) if c == "1"]
        out.append(F.when(at + F.lit(len(mask)) <= size, F.xxhash64(F.lit(number), *kept)))
    return F.array(*out)


def _seeded(rows: DataFrame, masks: Sequence[str]) -> DataFrame:
    """`seed` and its place `at` for all rows with `hashes` and `size`."""
    least = min(len(m) for m in masks)
    placed = rows.where(F.col("size") >= least).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("size") - F.lit(least))))
    return placed.withColumn("seed", F.explode(seeds(F.col("hashes"), F.col("at"), F.col("size"), masks))).where("seed is not null")


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] = MASKS,
    min_words: int = MIN_WORDS,
    broadcast_seeds: int = BROADCAST_SEEDS,
    least_item: int = SHORTEST,
) -> DataFrame:
    """One row for each document, item and alignment that overlap.

    Columns: row key, id, item_id, doc_start and item_start (word numbers), n_words (length of the overlap), n_equal
    (equal words in it), item_words. An overlap has at least `min_words` equal words, or all words of a shorter item.
    Items of fewer than `least_item` words and null or empty texts match nothing: such an item is a phrase of everyday
    text. Items with equal texts are reported each, an id with several texts once for each text, items without an id
    with a null one; equal documents share a key and are reported once. Empty tables give no rows; other columns are
    not read.
    """
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), words(F.col(f"`{item_text_col}`")).alias("hashes"))
    items = items.withColumn("size", F.size("hashes")).where(F.col("size") >= least_item)
    items = stored(items.withColumn("print", F.md5(F.array_join(F.transform("hashes", lambda h: h.cast("string")), " "))))
    texts = items.select("print", "hashes", "size").dropDuplicates(["print"])
    shortest = min(len(m) for m in masks)
    # an item too short for a mask is looked for as a whole: one full mask per such length, at most `shortest` of them
    short = [r.size for r in items.where(F.col("size") < shortest).select("size").distinct().collect()]
    every = [*masks, *("1" * n for n in sorted(short))]
    index = stored(_seeded(texts, every).select("seed", "print", F.col("at").alias("item_at"), F.col("size").alias("item_words")).distinct())
    rows = docs.select(row_key(id_col, text_col).alias(KEY), F.col(f"`{id_col}`").alias("id"), words(F.col(f"`{text_col}`")).alias("hashes"))
    rows = rows.withColumn("size", F.size("hashes")).where("hashes is not null")
    start = (F.col("at") - F.col("item_at")).alias("start")
    if index.count() <= broadcast_seeds:
        hits = _seeded(rows, every).join(F.broadcast(index), "seed").select(KEY, "id", "hashes", "print", "item_words", start)
    else:
        narrow = _seeded(rows.select(KEY, "hashes", "size"), every).select(KEY, "at", "seed")
        placed = narrow.join(index, "seed").select(KEY, "print", "item_words", start).distinct()
        hits = placed.join(rows.select(KEY, "id", "hashes"), KEY)
    # the document's words from the place of the item's first word on; 0 stands for words outside
    front = F.greatest(-F.col("start"), F.lit(0))
    inner = F.slice("hashes", F.greatest(F.col("start"), F.lit(0)) + 1, F.greatest(F.col("item_words") - front, F.lit(0)))
    lying = F.when(front > 0, F.concat(F.array_repeat(F.lit(0).cast("long"), front), inner)).otherwise(inner)
    hits = hits.select(KEY, "id", "print", "start", lying.alias("lying"))
    aligned = hits.groupBy(KEY, "print", "start").agg(F.first("id").alias("id"), F.first("lying").alias("lying"))
    both = aligned.join(texts.withColumnRenamed("hashes", "item"), "print")
    equal = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.coalesce(F.get("lying", i) == F.get("item", i), F.lit(False)))
    best = both.withColumn("best", _segment(equal))
    long_enough = F.col("best.equal") >= F.least(F.lit(min_words), F.col("size"))
    found = best.where(long_enough).join(items.select("item_id", "print").distinct(), "print")
    return found.select(
        KEY, F.col("id").alias(id_col), "item_id", (F.col("start") + F.col("best.from")).cast("long").alias("doc_start"),
        F.col("best.from").cast("long").alias("item_start"), (F.col("best.to") - F.col("best.from")).cast("long").alias("n_words"),
        F.col("best.equal").cast("long").alias("n_equal"), F.col("size").cast("long").alias("item_words"),
    )


def _segment(equal: Column) -> Column:
    """The segment with the highest score: +1 for an equal word, -PENALTY for a different one; of ties the most equal words."""

    def state(score, at, begin, equals, top, low, high, most):  # noqa: ANN001, ANN202
        names = ("score", "at", "begin", "equals", "top", "from", "to", "equal")
        values = (score, at, begin, equals, top, low, high, most)
        return F.struct(*[v.cast("int").alias(n) for n, v in zip(names, values, strict=True)])

    def step(s, hit):  # noqa: ANN001, ANN202
        fresh = s["score"] < 0
        begin = F.when(fresh, s["at"]).otherwise(s["begin"])
        score = F.when(fresh, F.lit(0)).otherwise(s["score"]) + F.when(hit, F.lit(1)).otherwise(F.lit(-PENALTY))
        equals = F.when(fresh, F.lit(0)).otherwise(s["equals"]) + hit.cast("int")
        at = s["at"] + 1
        better = (score > s["top"]) | ((score == s["top"]) & (equals > s["equal"]))
        return state(
            score, at, begin, equals, F.greatest(score, s["top"]), F.when(better, begin).otherwise(s["from"]),
            F.when(better, at).otherwise(s["to"]), F.when(better, equals).otherwise(s["equal"]),
        )

    zero = F.lit(0)
    return F.aggregate(equal, state(zero, zero, zero, zero, zero, zero, zero, zero), step)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """One row per document and item id, with the best alignment: most equal words, then the first.

    Items that share an id, or have none, count as one item with several texts.
    """
    found = overlaps(docs, benchmark, id_col, text_col, **options)
    order = F.struct(F.col("n_equal"), -F.col("doc_start"), -F.col("item_start"), F.col("n_words"), F.col("item_words"))
    best = found.groupBy(KEY, "item_id").agg(F.first(id_col).alias(id_col), F.max(order).alias("best"))
    fields = ("n_equal", "n_words", "item_words")
    return best.select(
        id_col, "item_id", (-F.col("best.col2")).alias("doc_start"), (-F.col("best.col3")).alias("item_start"),
        *[F.col(f"best.{f}").alias(f) for f in fields], KEY,
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """Rows of `docs` that overlap with no item, all columns."""
    bad = overlaps(docs, benchmark, id_col, text_col, **options).select(KEY).distinct()
    names = docs.columns
    marked = docs.withColumn(KEY, row_key(id_col, text_col)).join(bad, KEY, "left_anti")
    return marked.select(*[F.col(f"`{c}`") for c in names])
