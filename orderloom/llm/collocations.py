"""Phrases whose words keep together, found by best-first growth from prefixes.

A phrase of 2 to 4 words that occurs `a` times scores 2,000,000 a / (l + r) at a cut into parts that occur l and r
times; its lowest cut counts. A phrase inside a longer frequent one that occurs nearly as often is dropped. Wanted are
the best of each language.

Counting all phrases of 3 and 4 words of a corpus would ship most of it. Growth is bounded instead:

- A phrase that begins with the prefix p scores at most B(p) = 2,000,000 f(p) / (f(first word of p) + f(p)): cut after the
  first word, the rest occurs as often as the phrase at least, and the phrase as often as p at most. The same holds for
  a phrase that ends with p and p's last word. Both bounds fall, or stay, with every word that is added.
- The frontier is expanded best first, in batches. A batch is a limit per language, the score of the language's 4,000th
  best pair at first. Only prefixes with a bound at or above the limit are grown to the right, only endings with such a
  bound to the left, and only where both shorter phrases occur often enough. A shorter phrase that was not counted, as
  no bound asked for it, may occur often: where only that is unknown, the longer phrase is counted. It may drop the
  other shorter one.
- All phrases with a score at or above the limit, their parts, and every longer phrase that could drop them are counted
  then. A language with 2,000 undropped phrases at or above its limit is settled, ties included. The others go on with
  a limit four times as deep, until the limit is zero and nothing is left to grow.

A pass over the texts counts inside chunks of a few megabytes by arrays and sends each different phrase of a chunk once.
Which phrases may grow is told by a bit table of fixed size; a phrase let through by chance is counted in vain, its
count is as right as any other. In a chunk phrases are told apart by 64-bit hashes and their length, from then on by
their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.texthash import mixed, powers
from orderloom.session import stored

LEAST, MOST_WORDS, TOP, SCALE = 30, 4, 2000, 2_000_000
#: A phrase is dropped when 100 times the count of a longer one reaches this many times its own.
DROPPED_AT = 80
#: Pairs per language in the first batch, in multiples of `top`; each later batch is this much deeper.
FIRST_BATCH, DEEPER = 2, 4
CHUNK_BYTES, BLOCK_ROWS, SALTS = 1_000_000, 50_000, 32
TABLE_BITS = 26  # 8 MB, whatever the corpus

_U = np.uint64
_BASE, _LENGTH, _KINDS = 0xD6E8FEB86659FD93, _U(0xA0761D6478BD642F), {k: _U(v) for k, v in {"often": 0x1F83D9AB, "right": 0x5BE0CD19, "left": 0x3C6EF372}.items()}
_VALUE = np.random.default_rng(20250312).integers(1, 2**63, 256, dtype=np.uint64)
_BREAK, _WORD = np.zeros(256, bool), np.ones(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_WORD[_BREAK] = False
_WORD[[9, 32]] = False


@dataclass
class Chunk:
    """Words of a stretch of texts: `data` has them in lower case with one space behind each, so a phrase is one span."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    #: Words from each word to the end of its piece.
    room: np.ndarray

    def __post_init__(self) -> None:
        self._sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_VALUE[self.data] * powers(_BASE, len(self.data)), out=self._sums[1:])
        self._back = powers(pow(_BASE, -1, 2**64), len(self.data) + 1)

    def hashes(self, at: np.ndarray, size: int, salts: np.ndarray) -> np.ndarray:
        """Hash of the phrase of `size` words at each place and of its language's salt."""
        start, end = self.starts[at], self.ends[at + size - 1]
        spans = (self._sums[end] - self._sums[start]) * self._back[start]
        return mixed(spans ^ salts[self.rows[at]] ^ ((end - start).astype(np.uint64) * _LENGTH))

    def phrases(self, at: np.ndarray, size: int) -> pa.StringArray:
        start, end = self.starts[at], self.ends[at + size - 1]
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(end - start, out=offsets[1:])
        places = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.data[places].tobytes()))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Words of all texts. A chunk ends with a text or, in a text longer than a chunk, behind a mark that ends a piece."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    everything = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        end = min(at + size, stop)
        if end < stop:
            row = int(np.searchsorted(offsets, end, "right")) - 1
            if offsets[row] > at:
                end = int(offsets[row])
            else:
                marks = _BREAK[everything[end : offsets[row + 1]]]
                end = end + int(marks.argmax()) + 1 if marks.any() else int(offsets[row + 1])
        yield _chunk(everything[at:end], offsets, at)
        at = end


def _chunk(data: np.ndarray, offsets: np.ndarray, at: int) -> Chunk:
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(data), "right")] - at] = True
    edge[0] = True
    first = word & (edge[:-1] | np.concatenate([[True], ~word[:-1]]))
    last = word & (edge[1:] | np.concatenate([~word[1:], [True]]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts + at, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    new = np.ones(len(starts), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (breaks[starts[1:]] > breaks[starts[:-1]])
    pieces = np.flatnonzero(new)
    sizes = np.diff(np.append(pieces, len(starts)))
    room = np.repeat(pieces + sizes, sizes) - np.arange(len(starts))
    lengths = ends - starts
    spaced = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    spaced[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = data[word]
    ends = np.cumsum(lengths + 1) - 1
    return Chunk(spaced, ends - lengths, ends, rows, room)


def _salt(lang: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def _salts(langs: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The languages of some rows as a plain array, and their salts."""
    coded = langs.dictionary_encode()
    each = np.array([_salt(x) for x in coded.dictionary.to_pylist()], np.uint64)
    return langs, each[coded.indices.to_numpy(zero_copy_only=False)] if len(langs) else each


class Table:
    """Which phrases may grow, as bits of a table; a few strangers may pass, none that was put in is missed."""

    def __init__(self, places: np.ndarray, bits: np.ndarray, table_bits: int) -> None:
        self.bits, self.shift = np.zeros(1 << table_bits >> 6, np.uint64), _U(64 - table_bits)
        self.bits[places] = bits.view(np.uint64)

    def has(self, hashes: np.ndarray, kind: str) -> np.ndarray:
        place = mixed(hashes ^ _KINDS[kind]) >> self.shift
        return (self.bits[place >> _U(6)] >> (place & _U(63))) & _U(1) == 1


def table_of(phrases: DataFrame, size: int, table_bits: int = TABLE_BITS) -> Table:
    """The table of (lang, phrase, right, left): every phrase occurs often, `right` and `left` say which way it may grow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, salts = _salts(batch.column(0))
            for chunk in chunks(batch.column(1)):
                at = np.flatnonzero(np.diff(chunk.rows, prepend=-1))
                hashes = chunk.hashes(at, size, salts)
                kept = [hashes ^ _KINDS["often"]]
                kept += [hashes[np.asarray(batch.column(i))[chunk.rows[at]]] ^ _KINDS[k] for i, k in ((2, "right"), (3, "left"))]
                place = np.unique(mixed(np.concatenate(kept)) >> _U(64 - table_bits))
                words, begin = np.unique(place >> _U(6), return_index=True)
                bits = np.bitwise_or.reduceat(_U(1) << (place & _U(63)), begin) if len(place) else place
                yield pa.RecordBatch.from_pydict({"place": pa.array(words.astype(np.int64)), "bits": pa.array(bits.view(np.int64))})

    found = phrases.select("lang", "phrase", "right", "left").mapInArrow(run, "place long, bits long")
    got = found.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2**table_bits / 64 rows
    return Table(got["place"].to_numpy(), got["bits"].to_numpy(), table_bits)


def counted(texts: DataFrame, size: int, table: Table | None, least: int, lower: dict[int, Table] | None = None) -> DataFrame:
    """(lang, phrase, a): phrases of `size` words that `table` lets through and that occur `least` times or more.

    `lower` has the tables of fewer words, from the size up whose phrases were all counted; without it that is `table`.
    Single words are all counted, and a null phrase has the number of words of its language.
    """
    shared = texts.sparkSession.sparkContext.broadcast({**(lower or {}), size - 1: table})  # each of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            langs, salts = _salts(batch.column(0))
            for chunk in chunks(batch.column(1)):
                if size == 1:
                    row, n = np.unique(chunk.rows, return_counts=True)
                    yield _batch(langs, row, pa.nulls(len(row), pa.string()), n)
                    at = np.arange(len(chunk.rows))
                else:
                    at = np.flatnonzero(chunk.room >= size)
                    at = at[_may_grow(chunk, at, size, salts, tables)[0]]
                hashes = chunk.hashes(at, size, salts)
                order = np.argsort(hashes, kind="stable")
                new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]])) if len(at) else at
                n, at = np.diff(np.append(new, len(at))), at[order[new]]
                for block in range(0, len(at), BLOCK_ROWS):
                    some = at[block : block + BLOCK_ROWS]
                    yield _batch(langs, chunk.rows[some], chunk.phrases(some, size), n[block : block + BLOCK_ROWS])

    found = texts.mapInArrow(run, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return found.where((F.col("a") >= least) | F.col("phrase").isNull())


def _may_grow(chunk: Chunk, at: np.ndarray, size: int, salts: np.ndarray, tables: dict[int, Table]) -> tuple[np.ndarray, np.ndarray]:
    """Of the places where a phrase of `size` words is: where it is to be counted, and where it may be frequent.

    It is counted if one of the two shorter phrases may grow into it and the other may be frequent: by the table or, where
    that one was not to be counted itself, by its own parts.
    """
    table = tables[size - 1]
    before, after = chunk.hashes(at, size - 1, salts), chunk.hashes(at + 1, size - 1, salts)
    right, left = table.has(before, "right"), table.has(after, "left")
    if size - 1 == min(tables):
        often = table.has(before, "often") & table.has(after, "often")
        return often & (right | left), often
    maybe = []
    for hashes, place in ((before, at), (after, at + 1)):
        asked, parts = _may_grow(chunk, place, size - 1, salts, tables)
        maybe.append(np.where(asked, table.has(hashes, "often"), parts))
    often = maybe[0] & maybe[1]
    return often & (right | left), often


def _batch(langs: pa.Array, rows: np.ndarray, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"lang": langs.take(pa.array(rows)), "phrase": phrases, "a": pa.array(n.astype(np.int64))})


def _exact(c: Column | str) -> Column:
    """For products that pass 64 bits."""
    return F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")


def _score(a: Column, both: Column) -> Column:
    """floor(SCALE a / both), exact."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * _exact(a), both)


def scored(phrases: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, a, k, l, r, score, right, left): the lowest cut, and the bounds for growing to either side.

    `parts` has the counts of all shorter phrases that matter. A phrase with a part that was not counted scores below the
    limit of its batch (a part at or above it is always counted) and has a null score.
    """
    cuts = range(1, size)
    looked = [F.struct(F.lit(k).alias("at"), F.substring_index("phrase", " ", k).alias("part")) for k in cuts]
    looked += [F.struct(F.lit(-k).alias("at"), F.substring_index("phrase", " ", k - size).alias("part")) for k in cuts]
    each = phrases.select("lang", "phrase", "a", F.explode(F.array(*looked)).alias("x")).select("lang", "phrase", "a", "x.at", "x.part")
    known = parts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    of = {i: F.max(F.when(F.col("at") == i, F.col("f"))).alias(f"{'l' if i > 0 else 'r'}{abs(i)}") for k in cuts for i in (k, -k)}
    rows = each.join(known, ["lang", "part"]).groupBy("lang", "phrase").agg(F.max("a").alias("a"), *of.values())
    choices = [
        F.struct(_score(F.col("a"), _exact(f"l{k}") + _exact(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in cuts
    ]  # the lowest, then the smallest k
    whole = reduce(lambda x, y: x & y, [F.col(f"{s}{k}").isNotNull() for k in cuts for s in "lr"])
    best = F.when(whole, F.array_min(F.array(*choices)))
    right, left = (_score(F.col("a"), _exact(c) + _exact("a")) for c in ("l1", f"r{size - 1}"))
    return rows.select("lang", "phrase", "a", best.alias("best"), right.alias("right"), left.alias("left")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score", "right", "left"
    )


def _limit(rows: DataFrame, nth: int) -> DataFrame:
    """(lang, limit): the nth best score, of languages that have so many. Scores are counted first: 1,000,001 at most."""
    down = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.where("score is not null").groupBy("lang", "score").agg(F.count("*").alias("n"))
    return counts.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= nth).groupBy("lang").agg(F.max("score").alias("limit"))


def _grow(phrases: DataFrame, limits: DataFrame) -> DataFrame:
    """Phrases of the open languages, marked where a bound reaches the limit."""
    rows = phrases.join(limits, "lang")
    marks = [F.coalesce(F.col(c) >= F.col("limit"), F.lit(True)).alias(c) for c in ("right", "left")]
    return rows.select("lang", "phrase", *marks)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    dropped_at: int = DROPPED_AT,
    first_batch: int = FIRST_BATCH,
    table_bits: int = TABLE_BITS,
) -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n (words of the language), score.

    Words are runs of anything but space, tab and the marks that end a piece (`.,;:!?` and line ends), in lower case as
    far as A-Z goes; no phrase crosses a piece. Order: score, then count, both descending, then the phrase by its bytes.
    A null language is `und`. Null and empty texts add nothing, repeated rows count each time, an empty table gives no
    rows, and so does a language without a frequent pair. Very long texts are cut between pieces. Other columns are not
    read. The score is exact for counts of up to 19 digits.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    counts = stored(counted(texts, 1, None, least))
    totals = counts.where("phrase is null").select("lang", F.col("a").alias("n"))
    words = counts.where("phrase is not null")
    both = F.lit(True)
    pairs = counted(texts, 2, table_of(words.select("lang", "phrase", both.alias("right"), both.alias("left")), 1, table_bits), least)
    pairs = stored(scored(stored(pairs), words, 2))
    open_langs = totals.select("lang")
    batch, done = first_batch * top, []
    while True:
        limits = stored(open_langs.join(_limit(pairs.join(open_langs, "lang"), batch), "lang", "left").select("lang", F.coalesce("limit", F.lit(0)).alias("limit")))
        known, levels, tables = [words.select("lang", "phrase", "a"), pairs.select("lang", "phrase", "a")], [pairs], {}
        for size in range(3, MOST_WORDS + 1):
            tables[size - 1] = table_of(_grow(levels[-1], limits), size - 1, table_bits)
            longer = stored(counted(texts, size, tables[size - 1], least, dict(tables)))
            levels.append(stored(scored(longer, reduce(DataFrame.unionByName, known), size)))
            known.append(longer)
        inside = reduce(DataFrame.unionByName, known[2:]).select(
            "lang", F.col("a").alias("f"),
            F.explode(F.array(F.expr("substring(phrase, 1, length(phrase) - locate(' ', reverse(phrase)))"), F.expr("substring(phrase, locate(' ', phrase) + 1)"))).alias("phrase"),
        ).groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
        found = reduce(DataFrame.unionByName, levels).join(limits, "lang").where("score >= limit").join(inside, ["lang", "phrase"], "left")
        drop = 100 * _exact(F.coalesce("longest", F.lit(0))) >= dropped_at * _exact("a")
        kept = stored(found.where(~drop).select("lang", "phrase", "a", "l", "r", "score", "limit"))
        enough = stored(_limit(kept, top).select("lang", F.col("limit").alias("last")))
        settled = limits.join(enough, "lang", "left").where("last is not null or limit = 0").select("lang", F.coalesce("last", F.lit(0)).alias("last"))
        done.append(_ranked(kept.join(settled, "lang").where("score >= last"), top))
        open_langs = stored(limits.select("lang").join(settled, "lang", "left_anti"))
        if open_langs.isEmpty():
            break
        batch *= DEEPER
    return reduce(DataFrame.unionByName, done).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each language, first within slices of it, so that many ties are no group of one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = Window.partitionBy("lang", "slice").orderBy(*order)
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "score")
