"""Personal data: fixed patterns, and identifiers found by bootstrapping from their contexts.

Base kinds `email`, `ip`, `card` and `phone` are fixed patterns, leftmost and non-overlapping for each kind. The kind
`context` is bootstrapped. Units of text are possible identifiers: what reads like a phone or a spaced card, and words
with several digits, an @ or four numbers between dots. Units that hold a base span are seeds, whatever their digits.
The words around a unit (two before, one before and one after, two after; a neighbouring unit counts as the word #) are
its patterns. Pattern and unit form a graph that Spark scores in rounds until no pattern is added: a pattern is trusted
when the scores of its units, against their number and one more, reach the threshold; a unit that is no seed takes the
trust of the pattern that found it first. Five seeds are enough for one unseen unit. Units of a trusted pattern are
reported wherever it holds.

Built-in expressions only. Texts are read once; what is kept of them are spans and possible identifiers. Distinct
pairs of pattern and unit are counted, so copies of a text add nothing and are merged before the shuffle. Expressions
that could recurse or backtrack on long runs are possessive or start at the beginning of a run only, and an array that
a lambda reads is bound once (`_with`), so a text of n matches takes about n times the root of n small steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import KEY, row_key
from orderloom.session import stored

KINDS = ("email", "ip", "card", "phone", "context")
#: A trusted pattern, the units that its count is raised by, and the digits that make a unit without @ or dots possible.
THRESHOLD, DISCOUNT, LEAST_DIGITS = 0.7, 1.0, 5
_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"

# The same matches as the plain patterns in the docstring of `base_spans`.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain to be worth a pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_WORD = r"[^\x20\x09-\x0D]"
_SPACES = r"[\x20\x09-\x0D]"
_DOTTED = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]"
_UNIT = (
    rf"{PATTERNS['phone']}|{PATTERNS['card']}|(?<!{_WORD})"
    rf"(?:(?=(?:[^\x20\x09-\x0D0-9]*+[0-9]){{{LEAST_DIGITS}}})|(?=[^\x20\x09-\x0D@]*+@)|(?=[^\x20\x09-\x0D0-9]*+{_DOTTED})){_WORD}++"
)
_EDGE = r"^[\[\]()<>{}\"',.;:!?]+|[\[\]()<>{}\"',.;:!?]+$"


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut before every match; from the second piece on each is match, _CLOSE, rest."""
    return F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, in which the value is computed once, also where lambdas read it."""
    return F.transform(F.array(value), use)[0]


def _running(lengths: Column) -> Column:
    """Sum of the lengths before each place: sums inside blocks of root size, then the sums of the blocks before."""

    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(values, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["before"], F.array(s["at"])).alias("before")))

    def joined(blocks: Column) -> Column:
        firsts = sums(F.transform(blocks, lambda x: x["at"]))["before"]
        return F.flatten(F.zip_with(blocks, firsts, lambda x, first: F.transform(x["before"], lambda v: v + first)))

    def cut(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")
        starts = F.sequence(F.lit(1), F.size(values), width)
        return _with(F.transform(starts, lambda at: sums(F.slice(values, at, width))), joined)

    return _with(lengths, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(F.array().cast("array<int>")))


def _located(pieces: Column) -> Column:
    """(start, end, value) of the matches, in code points. `pieces` is read several times: bind it first."""
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    before = _running(F.transform(rest, lambda piece: F.length(piece) - 1))

    def span(piece, at):  # noqa: ANN001, ANN202
        value = F.substring_index(piece, _CLOSE, 1)
        start = F.length(pieces[0]) + at
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    return F.zip_with(rest, before, span)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)

    def add(total, i):  # noqa: ANN001, ANN202
        d = F.substring(back, i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array of (kind, start, end) by kind, then start.

    email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`; ip `[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)` with parts
    of at most 255; card `[0-9]([ -]?[0-9])+` with 16 to 19 digits that pass Luhn; phone `\\+[0-9][ ().0-9-]+[0-9]` with
    8 to 15 digits. Matches that fail are dropped without a retry. `text` must not hold the characters U+0001, U+0002.
    """
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    out = []
    for kind in KINDS[:-1]:
        needed = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike("[0-9]{4}|[0-9][ -][0-9]")
        good = F.filter(_with(_pieces(text, PATTERNS[kind]), _located), lambda m: _valid(kind, m["value"]))  # noqa: B023
        spans = F.transform(good, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))  # noqa: B023
        out.append(F.when(needed, spans).otherwise(none))
    return F.concat(*out)


def _units(text: Column) -> Column:
    """(start, end, token, contexts) of the possible identifiers; punctuation at a unit's edges is not part of it."""
    none = F.array().cast("array<struct<start:int,end:int,token:string,contexts:array<string>>>")
    found = _with(_pieces(text, _UNIT), lambda pieces: F.transform(_located(pieces), lambda m, i: _in_context(pieces, m, i)))
    return F.when(text.rlike("[0-9@]"), found).otherwise(none)


def _in_context(pieces: Column, m: Column, i: Column) -> Column:
    """Match number i with its patterns, made of whole words of any length; # stands for the units beside it."""
    left = F.concat(F.when(i > 0, F.lit("#")).otherwise(""), F.lower(F.substring_index(F.get(pieces, i), _CLOSE, -1)))
    right = F.concat(F.lower(F.substring_index(F.get(pieces, i + 1), _CLOSE, -1)), F.when(i + 2 < F.size(pieces), F.lit("#")).otherwise(""))
    one = F.regexp_extract(left, rf"(?<!{_WORD})({_WORD}++){_SPACES}*+$", 1)
    two = F.regexp_extract(left, rf"(?<!{_WORD})({_WORD}++{_SPACES}++{_WORD}++){_SPACES}*+$", 1)
    next_one = F.regexp_extract(right, rf"^{_SPACES}*+({_WORD}++)", 1)
    next_two = F.regexp_extract(right, rf"^{_SPACES}*+({_WORD}++{_SPACES}++{_WORD}++)", 1)
    token = F.regexp_replace(m["value"], _EDGE, "")
    start = m["start"] + F.length(F.regexp_extract(m["value"], r"^[\[\]()<>{}\"',.;:!?]+", 0))
    contexts = F.array(
        F.when(two != "", F.concat(F.lit("L2 "), F.regexp_replace(two, r"\s+", " "))),
        F.when((one != "") & (next_one != ""), F.concat(F.lit("LR "), one, F.lit(" "), next_one)),
        F.when(next_two != "", F.concat(F.lit("R2 "), F.regexp_replace(next_two, r"\s+", " "))),
    )
    return F.struct(start.alias("start"), (start + F.length(token)).alias("end"), token.alias("token"), F.filter(contexts, lambda c: c.isNotNull()).alias("contexts"))


def extract(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    discount: float = DISCOUNT,
    least_digits: int = LEAST_DIGITS,
) -> DataFrame:
    """One row per input row: row key, id, and `found`, an array of (kind, start, end) by kind as listed, then start.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Equal rows get equal answers; copies
    of a text count once as evidence. Texts of any length are read whole. Of patterns with equal trust all are used. An
    empty table gives no rows; other columns are not read. Rounds end with the first that adds no pattern: every round
    adds one at least, and a unit's score never changes once it has one.
    """
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), _OPEN + _CLOSE, _OTHER + _OTHER)  # same length, matched by no pattern
    rows = docs.select(row_key(id_col, text_col).alias(KEY), F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    rows = stored(rows.select(KEY, "id", base_spans(F.col("t")).alias("base"), _units(F.col("t")).alias("units")))
    each = rows.where(F.size("units") > 0).select(KEY, F.explode("units").alias("k")).select(KEY, "k.*")
    each = each.withColumn("seed", F.size(base_spans(F.col("token"))) > 0)
    possible = F.col("token").contains("@") | F.col("token").rlike(_DOTTED) | (F.length(_digits(F.col("token"))) >= least_digits)
    each = each.where(F.col("seed") | possible)
    occurrences = stored(each.select(KEY, "start", "end", "token", "seed", F.explode("contexts").alias("pattern")))
    # the graph: distinct pairs, a unit being a seed wherever it was one
    pairs = stored(occurrences.groupBy("pattern", "token").agg(F.max("seed").alias("seed")))
    scores = pairs.groupBy("token").agg(F.max("seed").cast("double").alias("score"))
    good = None
    while True:
        weighed = pairs.select("pattern", "token").join(scores, "token")
        patterns = weighed.groupBy("pattern").agg((F.sum("score") / (F.count("*") + F.lit(discount))).alias("trust"))
        trusted = patterns.where(F.col("trust") >= threshold)
        added = stored(trusted if good is None else trusted.join(good, "pattern", "left_anti"))
        if good is not None and added.isEmpty():
            break
        good = added if good is None else stored(good.unionByName(added))
        lifted = pairs.select("pattern", "token").join(added, "pattern").groupBy("token").agg(F.max("trust").alias("trust"))
        score = F.when(F.col("score") > 0, F.col("score")).otherwise(F.coalesce("trust", F.lit(0.0)))
        scores = stored(scores.join(lifted, "token", "left").select("token", score.alias("score")))
    fresh = occurrences.where(~F.col("seed")).join(good.select("pattern"), "pattern", "left_semi")
    span = F.struct(F.lit("context").alias("kind"), F.col("start"), F.col("end"))
    fresh = fresh.groupBy(KEY).agg(F.sort_array(F.collect_set(span)).alias("more"))
    out = rows.select(KEY, "id", "base").join(fresh, KEY, "left")
    found = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return out.select(KEY, F.col("id").alias(id_col), found.alias("found"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of `extract`."""

    def joined(spans):  # noqa: ANN001, ANN202
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["kind"] != "context")
    counts = [F.size(F.filter("found", lambda x: x["kind"] == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
