"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash. Each gets a virtual finish time: the words of its source up to and
including it, divided by the target of its source. All sources' documents are merged in the order of that time and
cut off at the total budget, so at any cut every source has had its share to within a document. A source whose target
is above its own size goes round again, up to `max_repeats` times.

Running sums are taken in fixed hash buckets of a source, with the sums of earlier buckets added, and the global order
is found over equal slices of virtual time, each of which holds about the same number of words whatever the sources'
sizes. So no task ever holds a whole source, and only the slice where the budget ends is sorted. Sources are a table, too:
their targets are found by small aggregates, and join the sums of the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.rows import KEY, row_key
from orderloom.operators.keys import with_row_index
from orderloom.session import stored

WEIGHTS, MAX_REPEATS = (1, 2, 3), 3
BUCKETS, SLICES = 1024, 4096
SEED = "mix"


def words_in(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009-U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shares(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, size) with the target words of each source: shares of all words by weight, at most `max_repeats` times its size.

    Sources are taken in code point order with null last, and weigh `weights` in turn. What a full source cannot take
    is shared among the others by weight, again and again until no target is above its limit. What one unit of weight
    gets only grows from round to round, so a round is one aggregate of three numbers, and its full sources are those
    whose limit the unit passes: sources stay a table however many there are. Sizes of 0 give targets of 0.
    """
    named = sizes.withColumn("unnamed", F.col("source").isNull())
    place = with_row_index(named, ["unnamed", "source"]).drop("unnamed")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_index") - 1, F.lit(len(weights))) + 1).cast("int"))
    each = stored(place.select("source", "size", turn.alias("weight"), (F.col("size") * max_repeats).cast("double").alias("limit")))
    all_ = each.agg(F.sum("size").alias("words"), F.sum("weight").alias("weight")).first()
    unit, n_full = (float(all_.words) / all_.weight if all_.weight else 0.0), 0
    while True:
        full = F.col("weight") * F.lit(unit) > F.col("limit")
        now = each.agg(
            F.count_if(full).alias("n"),
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("limits"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if now.n == n_full or not now.open:
            return each.select("source", "size", F.when(full, F.col("limit")).otherwise(F.col("weight") * F.lit(unit)).alias("target"))
        n_full, unit = now.n, max(unit, (float(all_.words) - now.limits) / now.open)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, source, size, source_size, target (of the source), taken (words the mix takes).

    taken is size times the number of rounds in which the document falls before the cut. Null ids, texts and sources
    are values like others: a null text has size 0 and takes nothing, null is a source of its own. Equal rows are
    told apart only by their count, and share rounds: of n equal rows each is placed separately. Reruns agree, since
    the order is a hash of the row. An empty table gives no rows. There may be any number of sources.
    """
    inner = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), words_in(F.col(f"`{text_col}`")).alias("size"),
        F.md5(F.concat_ws("\x1f", F.lit(SEED), F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))).alias("h"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner, strict=True)],
    )
    rows = stored(rows)  # texts are read once; what follows needs a few numbers of each document
    goal = stored(shares(rows.groupBy("source").agg(F.sum("size").alias("size")), weights, max_repeats))
    budget = float(goal.agg(F.sum("size")).first()[0] or 0)
    placed = _placed(rows, goal)
    # finish of each round, in parts of the target; documents without words take nothing
    rounds = F.transform(
        F.sequence(F.lit(0), F.lit(max_repeats - 1)),
        lambda r: (r * F.col("source_size") + F.col("upto")) / F.col("target"),
    )
    placed = placed.withColumn("finish", F.when((F.col("size") > 0) & (F.col("target") > 0), rounds).otherwise(F.array().cast("array<double>")))
    cut = _cut(placed, budget)
    taken = F.size(F.filter("finish", lambda x: x < F.lit(cut[0])))
    if cut[1] is not None:
        # the slice in which the budget ends: compare (finish, h) with the last document that fits
        last, mark = cut[1]
        taken = taken + F.size(F.filter("finish", lambda x: (x >= F.lit(cut[0])) & ((x < F.lit(last)) | ((x == F.lit(last)) & (F.col("h") <= F.lit(mark))))))
    out = placed.withColumn("taken", (taken * F.col("size")).cast("long"))
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken",
        *[F.col(n).alias(c) for n, c in zip(inner, keep, strict=True)],
    )


def _placed(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """`upto`: words of the source up to and including the row, in the order of `h`; source_size and target from `goal`.

    The sources' figures come along with the sums of their buckets, so a source that holds a third of all rows is
    1,024 keys of the join with the rows.
    """
    bucket = (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * BUCKETS / F.lit(2**32)).cast("int")
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket")) - F.col("in_bucket")
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), before.alias("before"))
    goal = goal.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target")
    sums = sums.join(goal, F.col("s").eqNullSafe(F.col("of"))).drop("of")
    inside = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("inside", inside)
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")), "left")
    return joined.withColumn("upto", F.col("before") + F.col("inside")).drop("bucket", "b", "s", "before", "inside")


def _cut(placed: DataFrame, budget: float) -> tuple[float, tuple[float, str] | None]:
    """Where the budget ends: all finishes below the first value, and in the slice from there up to (finish, h)."""
    each = placed.select("size", "h", F.explode("finish").alias("finish"))
    slot = F.least(F.floor(F.col("finish") * SLICES), F.lit(4 * SLICES)).cast("long")
    sums = each.groupBy(slot.alias("slot")).agg(F.sum("size").alias("words")).orderBy("slot").collect()  # 4 * SLICES at most
    done = 0
    for r in sums:
        if done + r.words > budget:
            break
        done += r.words
    else:
        return float("inf"), None
    low = r.slot / SLICES
    inside = each.where(slot == r.slot)
    running = F.sum("size").over(Window.orderBy("finish", "h").rowsBetween(Window.unboundedPreceding, 0))
    fits = inside.withColumn("running", running).where(F.col("running") <= budget - done)
    last = fits.agg(F.max(F.struct("finish", "h")).alias("last")).first().last
    return low, (None if last is None else (last.finish, last.h))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:  # noqa: ANN003
    """Rows of `docs` that the mix takes, with size, source_size, target and taken (repeated rows as one, with their sum).

    A column of `docs` that has one of these four names goes on as `input_<name>`. Of rows with equal id and text but
    other columns, the one that is smallest as JSON stays.
    """
    names, added = docs.columns, ("size", "source_size", "target", "taken")
    marked = docs.withColumn(KEY, row_key(id_col, text_col))
    taken = mix(marked, id_col, text_col, source_col, keep=(KEY,), **options).where("taken > 0")
    figures = [F.first(c).alias(c) for c in added[:3]]
    taken = taken.groupBy(KEY).agg(*figures, F.sum("taken").alias("taken"))
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    order = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col])).alias("order")
    kept = marked.select(KEY, row, order).join(taken.select(KEY, F.struct(*added).alias("figures")), KEY)
    kept = kept.groupBy(KEY).agg(F.min_by("row", "order").alias("row"), F.first("figures").alias("figures"))

    def free(name: str) -> str:
        while name in names or name in added:
            name = f"input_{name}"
        return name

    own = [F.col(f"row.`{c}`").alias(free(c) if c in added else c) for c in names]
    return kept.select(*own, *[F.col(f"figures.{c}").alias(c) for c in added])
