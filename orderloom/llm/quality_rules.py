"""Quality rules as a learned decision list.

Every text has a few statistics. From labelled rows a list of rules is learned by sequential covering: a rule is a
conjunction of thresholds, grown one condition at a time by FOIL's information gain on two thirds of the labelled rows
and pruned on the rest while that does not lower its precision; the rows it covers are set aside and the next rule is
learned. A rule under the limits of coverage or precision is given up and growth starts from the next best feature;
covering ends when no start is left, or too few bad rows for any rule. The result is one ordered Spark expression, so
applying it needs no join, no shuffle and no Python.

Learning looks at bins of each statistic only (quantiles of the labelled rows); every step is one small aggregation,
and a handful of counts per statistic reaches the driver, whatever the number of labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import stored

BINS, LEAST_COVER, LEAST_PRECISION = 24, 5, 0.9
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def with_statistics(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the statistics of every whole text; a null text counts as empty.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word equal to an earlier line),
    n_repeat_words (words in windows of three that occur twice or more, the first occurrence included), and the shares
    that rules look at (see FEATURES). Windows are sorted with their places inside the row; equal neighbours are
    repeats and sorted places give the covered words, so a text of n words takes n log n steps whatever repeats in it.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    # arrays of whole texts are made once, in a projection of their own
    rows = docs.select(
        *kept, text.alias("t"), F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACE, "") != "").alias("lines"),
    )
    n = F.size("w")
    # hashes are cheaper to sort than words; two distinct windows with one 64-bit hash are left to chance
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    rows = rows.select("*", windows.alias("grams")).withColumn("distinct_grams", F.size(F.array_distinct("grams")))
    ordered = F.when(
        F.col("distinct_grams") < F.size("grams"), F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    rows = rows.withColumn("ordered", ordered)
    same = F.filter("ordered", lambda x, i: (x["h"] == F.get("ordered", i - 1)["h"]) | (x["h"] == F.get("ordered", i + 1)["h"]))
    rows = rows.withColumn("places", F.sort_array(F.transform(same, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("last"))
    covered = F.aggregate("places", start, lambda s, p: F.struct((s["covered"] + F.least(F.lit(3), p - s["last"])).alias("covered"), p.alias("last")))
    long = "long"
    bare = F.translate("t", _SPACE, "")
    out = rows.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        n.cast(long).alias("n_words"), F.length(bare).cast(long).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).cast(long).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast(long).alias("n_dup_lines"),
        F.coalesce(covered["covered"], F.lit(0)).cast(long).alias("n_repeat_words"),
        F.size("lines").cast(long).alias("n_lines"), F.size(F.array_distinct("w")).cast(long).alias("n_distinct"),
        (F.length("t") - F.length(F.regexp_replace("t", "[A-Z]", ""))).cast(long).alias("n_upper"),
        (F.length("t") - F.length(F.translate("t", "0123456789", ""))).cast(long).alias("n_digits"),
        (F.length("t") - F.length(F.translate("t", "!?.,;:", ""))).cast(long).alias("n_marks"),
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    shares = {
        "mean_word": F.col("word_chars") / words, "symbol_share": F.col("n_symbols") / words, "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words, "distinct_share": F.col("n_distinct") / words, "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars, "mark_share": F.col("n_marks") / words, "line_words": F.col("n_words") / F.greatest("n_lines", F.lit(1)),
    }
    return out.withColumns(shares)


FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share", "line_words",
)


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str
    value: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c <= F.lit(self.value) if self.op == "<=" else c > F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {self.op} {self.value:g}"


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules in order, each for bad rows; the first that holds decides, and what none covers is good."""

    rules: list[Rule]

    def column(self) -> Column:
        """Number of the first rule that holds, from 1; 0 when none does."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            out = F.when(rule.column(), number) if out is None else out.when(rule.column(), number)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "\n".join(f"{n}. {r}" for n, r in enumerate(self.rules, 1))


def _thresholds(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    shares = [i / bins for i in range(1, bins)]
    # quantiles of the bad rows as well as of all: bad rows are few, and differ where the others have no quantile
    wanted = [F.percentile_approx(f, shares, 1000).alias(f"a{i}") for i, f in enumerate(features)]
    wanted += [F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), shares, 1000).alias(f"b{i}") for i, f in enumerate(features)]
    row = rows.agg(*wanted).first()
    return {f: sorted({float(x) for x in [*(row[f"a{i}"] or []), *(row[f"b{i}"] or [])]}) for i, f in enumerate(features)}


def _counts(rows: DataFrame, at: Sequence[str]) -> dict[str, dict[int, tuple[int, int]]]:
    """(good, bad) by feature and bin: at most features x thresholds rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"bin_{f}").alias("b")) for f in at])).alias("p")
    got = rows.select(pairs, "good", "bad").groupBy("p.f", "p.b").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    out: dict[str, dict[int, tuple[int, int]]] = {}
    for r in got:
        out.setdefault(r.f, {})[r.b] = (int(r.good), int(r.bad))
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]], barred: set[str]) -> Rule:
    """The rule that gains most at every step until it covers no good row; its first feature is none of `barred`.

    Every condition leaves fewer rows, so growth ends.
    """
    rule = Rule()
    held = rows
    while True:
        counts = _counts(held, list(cuts))
        good, bad = (sum(v[i] for v in next(iter(counts.values()), {}).values()) for i in (0, 1))
        if not bad or not good:
            break
        before, best = math.log2(bad / (good + bad)), (0.0, None)
        for f, values in cuts.items():
            if not rule.conditions and f in barred:
                continue
            low_good = low_bad = 0
            for b, value in enumerate(values):
                g, d = counts.get(f, {}).get(b, (0, 0))
                low_good, low_bad = low_good + g, low_bad + d
                for op, g2, d2 in (("<=", low_good, low_bad), (">", good - low_good, bad - low_bad)):
                    if d2 and g2 + d2 < good + bad:
                        gain = d2 * (math.log2(d2 / (g2 + d2)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(f, op, value))
        if best[1] is None:
            break
        rule.conditions.append(best[1])
        held = held.where(best[1].column())
    return rule


def _quality(rows: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """(good, bad) rows that each rule covers, in one pass."""
    row = rows.agg(*[F.coalesce(F.sum(F.when(r.column(), F.col(c))), F.lit(0)).alias(f"{c}{i}") for i, r in enumerate(rules) for c in ("good", "bad")]).first()
    return [(int(row[f"good{i}"]), int(row[f"bad{i}"])) for i in range(len(rules))]


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, tuple[int, int]]:
    """The shortest beginning of the rule with the best (bad - good) / (bad + good) on the pruning rows."""
    starts = [Rule(rule.conditions[:n]) for n in range(1, len(rule.conditions) + 1)]
    counts = _quality(rows, starts)
    worth = [(b - g) / (b + g) if b + g else -1.0 for g, b in counts]
    best = max(range(len(starts)), key=lambda i: (worth[i], -i))
    return starts[best], counts[best]


def learn(
    stats: DataFrame,
    bad_col: str,
    features: Sequence[str] = FEATURES,
    bins: int = BINS,
    least_cover: int = LEAST_COVER,
    least_precision: float = LEAST_PRECISION,
) -> DecisionList:
    """A decision list for rows where `bad_col` is true, from labelled statistics. Null labels are left out.

    Rows with equal statistics are counted first. Growing and pruning rows are told apart by a hash of the statistics
    with the label. Without labelled rows of both kinds the list is empty. A rule must cover `least_cover` pruning rows,
    the share `least_precision` of them bad; there is no other limit to the number of rules or conditions.
    """
    label = F.col(bad_col).cast("int")
    rows = stats.where(label.isNotNull()).groupBy(*features).agg(F.sum(1 - label).alias("good"), F.sum(label).alias("bad"))
    rows = stored(rows)
    cuts = _thresholds(rows.withColumn("bad", (F.col("bad") > 0).cast("int")), features, bins)
    cuts = {f: v for f, v in cuts.items() if v}
    if not cuts:
        return DecisionList([])
    rows = rows.select("*", *[_bin(F.col(f), cuts[f]).alias(f"bin_{f}") for f in cuts])
    rows = stored(rows.withColumn("prune", F.pmod(F.xxhash64(*features), F.lit(3)) == 0))
    out: list[Rule] = []
    left, barred = rows, set()
    bad_left = rows.where("prune").agg(F.sum("bad")).first()[0] or 0
    while bad_left >= least_precision * least_cover:
        rule = _grow(left.where(~F.col("prune")), cuts, barred)
        if not rule.conditions:
            break
        start = rule.conditions[0].feature
        rule, (good, bad) = _pruned(rule, left.where("prune"))
        if bad + good < least_cover or bad < least_precision * (bad + good):
            barred.add(start)
            continue
        out.append(rule)
        left, barred, bad_left = left.where(~rule.column()), set(), bad_left - bad
    return DecisionList(out)


def _bin(value: Column, cuts: Sequence[float]) -> Column:
    """Number of thresholds below the value, so bin b holds values up to cuts[b]."""
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts]), lambda x: x < value))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> tuple[DataFrame, DecisionList]:  # noqa: ANN003, E501
    """(id, statistics and `rule` of every row, the list learned from the rows that `labels` calls 0).

    Labels are joined by id; several labels of one id count as the lowest, labels without a row and null ids are left
    out. Repeated rows get equal answers, an empty table gives no rows, other columns are not read.
    """
    stats = stored(with_statistics(docs, text_col, (id_col,)))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg((F.min(label_col) == 0).alias("__bad"))
    rules = learn(stats.join(known, id_col), "__bad", **options)
    return stats.withColumn("rule", rules.column()), rules
