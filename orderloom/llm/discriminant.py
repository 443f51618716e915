"""Quality scores by a regularised quadratic discriminant over statistics of whole texts.

Every text has a few statistics (lengths, shares of kinds of characters, repetition), computed array-wise over chunks of
texts and transformed so that good texts lie in one cloud: logarithms of counts, log-odds of shares. Each class of
labelled rows is a normal distribution. Its covariance is shrunk towards the pooled one and then towards a multiple of
the identity, so that few rows, or statistics that hardly vary, still give a distribution. A score is the logistic of
the difference of both log-densities plus the log-odds of the classes: Mahalanobis distances through the inverse of each
class's Cholesky factor, which is made once and kept with the log-determinant in the model.

Means and covariances are aggregates of Spark over all labelled rows, 2 x (1 + p + p(p+1)/2) numbers whatever the size of
the corpus. The model is a few kilobytes; scoring is one matrix product a class and batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.texthash import Words, mixed, word_chunks
from orderloom.session import stored

#: Share of the pooled covariance in a class covariance, share of the identity, and rows that a class must have.
TO_POOLED, TO_IDENTITY, LEAST_ROWS = 0.1, 0.02, 2
#: Log-densities of more standard deviations than this differ by rounding only; keeps scores inside 0 and 1.
MOST_LOG_ODDS = 36.0
GOOD_FROM = 0.7

FEATURES = (
    "log_words", "word_length", "word_spread", "distinct", "top_word", "repeats", "upper", "digits", "marks", "symbols", "line_words",
)

_UPPER, _DIGIT, _MARK, _SYMBOL, _START = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[*b".,;:!?"]] = True
_SYMBOL[[*b"#*$%&|<>{}[]~^_=+\\/@"]] = True
_START[:] = True
_START[0x80:0xC0] = False  # bytes inside a character
#: Every text counts as if it had so many more words, or ten times as many characters, with usual values: a short text
#: then differs little from a usual one, and an empty text is a usual one of no length.
USUAL_WORDS, LEAST_LENGTH = 12, 20
USUAL = {
    "word_length": 5.5, "word_spread": 2.7, "distinct": 0.7, "top_word": 0.06, "repeats": 0.02, "upper": 0.03, "digits": 0.005, "marks": 0.03, "symbols": 0.001,
}


def _per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many flags each row has."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[edges])


def _log_odds(part: np.ndarray, whole: np.ndarray, usual: float, more: float = USUAL_WORDS) -> np.ndarray:
    return np.log((part + usual * more) / (whole - part + (1 - usual) * more))


def statistics(words: Words, edges: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a chunk; `edges` are the byte positions of the texts in it.

    Everything is finite for every text, empty ones included: without words the counts are 0 and the shares say nothing.
    """
    n_rows = len(words.offsets) - 1
    row = words.row_of_word()
    n = np.diff(words.offsets).astype(float)
    starts = np.concatenate([[0], np.cumsum(_START[words.data])])
    length = (starts[words.ends] - starts[words.starts]).astype(float)
    chars = np.bincount(row, length, n_rows)
    usual, spread = USUAL["word_length"], USUAL["word_spread"]
    mean = (chars + USUAL_WORDS * usual) / (n + USUAL_WORDS)
    squares = (np.bincount(row, length**2, n_rows) + USUAL_WORDS * (usual**2 + spread**2)) / (n + USUAL_WORDS)
    spread = np.sqrt(np.maximum(squares - mean**2, 0))
    # equal words of a row side by side
    order = np.lexsort((words.hashes, row))
    same = np.zeros(len(order), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (words.hashes[order][1:] == words.hashes[order][:-1])
    first = np.flatnonzero(~same)
    sizes = np.diff(np.append(first, len(order)))
    top = np.zeros(n_rows)
    np.maximum.at(top, row[order][first], sizes)
    distinct = np.bincount(row[order][first], minlength=n_rows).astype(float)
    # windows of three words that occur again in the row
    at = np.flatnonzero(words.room() >= 3)
    grams = mixed(words.windows(3)[at] ^ (row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    kinds = np.unique(grams, return_index=True)[1]
    windows = np.bincount(row[at], minlength=n_rows).astype(float)
    again = windows - np.bincount(row[at][kinds], minlength=n_rows)
    lines = 1 + _per_row(words.data == 10, edges).astype(float)
    size = _per_row(_START[words.data], edges).astype(float)
    kinds_of = {"upper": _UPPER, "digits": _DIGIT, "marks": _MARK, "symbols": _SYMBOL}
    out = [np.log(np.maximum(n, LEAST_LENGTH)), np.log(mean), np.log1p(spread)]
    out += [_log_odds(part, whole, USUAL[k]) for k, part, whole in (("distinct", distinct, n), ("top_word", top, n), ("repeats", again, windows))]
    out += [_log_odds(_per_row(flags[words.data], edges).astype(float), size, USUAL[k], 10 * USUAL_WORDS) for k, flags in kinds_of.items()]
    out.append(np.log((n + USUAL_WORDS) / (lines + 1)))
    return np.column_stack(out)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one array of FEATURES) of every whole text; a null text counts as empty."""
    taken = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            parts = []
            for words in word_chunks(texts):
                parts.append(statistics(words, np.concatenate([[0], np.cumsum(sizes[words.rows])]).astype(np.int64)))
            flat = np.concatenate([np.zeros((0, len(FEATURES))), *parts]).ravel()
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["id", "x"])

    return taken.mapInArrow(run, f"id {taken.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Gaussian:
    """A class: log-odds weight, mean, inverse Cholesky factor of the covariance and half its log-determinant."""

    log_share: float
    mean: np.ndarray
    whitener: np.ndarray
    half_log_det: float

    @classmethod
    def of(cls, share: float, mean: np.ndarray, covariance: np.ndarray) -> Gaussian:
        factor = np.linalg.cholesky(covariance)
        return cls(float(np.log(share)), mean, np.linalg.inv(factor), float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        """Up to a constant that all classes share."""
        return self.log_share - self.half_log_det - 0.5 * (((x - self.mean) @ self.whitener.T) ** 2).sum(axis=1)


@dataclass(frozen=True)
class Discriminant:
    """Both classes, or the share of good rows where the labels do not give two distributions."""

    bad: Gaussian | None
    good: Gaussian | None
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class, between 0 and 1."""
        if self.bad is None or self.good is None:
            return np.full(len(x), self.share)
        odds = np.clip(self.good.log_density(x) - self.bad.log_density(x), -MOST_LOG_ODDS, MOST_LOG_ODDS)
        return 1 / (1 + np.exp(-odds))


def shrunk(own: np.ndarray, pooled: np.ndarray, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> np.ndarray:
    """A class covariance, first drawn to the pooled one, then to a multiple of the identity with the same trace."""
    drawn = (1 - to_pooled) * own + to_pooled * pooled
    size = max(float(np.trace(drawn)) / len(drawn), 1e-6)
    return (1 - to_identity) * drawn + to_identity * size * np.eye(len(drawn))


def fit(labelled: DataFrame, label_col: str = "label", to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant:
    """Fit on all rows of (x, label) whose label is 0 or 1; other labels are left out.

    With fewer than two rows of a class there is no distribution: every score is then the share of good rows, and 0.5
    without any row.
    """
    p = len(FEATURES)
    x = [F.col("x")[i] for i in range(p)]
    means = [F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]
    products = [F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    rows = labelled.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("label")).agg(F.count("*").alias("n"), *means, *products)
    got = {r["label"]: r for r in rows.collect()}  # two rows
    n = {k: got[k]["n"] if k in got else 0 for k in (0, 1)}
    total = n[0] + n[1]
    if min(n.values()) < LEAST_ROWS:
        return Discriminant(None, None, n[1] / total if total else 0.5)
    own = {k: np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)]) for k, r in got.items()}
    pooled = (n[0] * own[0] + n[1] * own[1]) / total
    made = {k: Gaussian.of(n[k] / total, np.array([r[f"m{i}"] for i in range(p)]), shrunk(own[k], pooled, to_pooled, to_identity)) for k, r in got.items()}
    return Discriminant(made[0], made[1], n[1] / total)


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """The rows of (id, x) with the column score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(x))], names=["id", "x", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>, score double")


def held_out(id_col: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo `parts`. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", good_from: float = GOOD_FROM
) -> tuple[DataFrame, Discriminant]:
    """(id, held_out, score, predicted of every row; the model learned from the labelled rows that are not held out).

    Nothing but the text is read for a score. Labels are joined by id for learning only; several labels of one id count
    as the lowest, labels of unknown ids and null ids or labels are left out. Equal texts have equal scores, a null text
    scores as an empty one, very long texts are read whole. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(with_statistics(docs, id_col, text_col))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).where("id is not null and label is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
    model = fit(rows.join(known, "id"))
    out = scored(rows, model).select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= good_from).cast("int").alias("predicted")
    )
    return out, model
