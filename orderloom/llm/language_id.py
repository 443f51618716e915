"""Language identification with a string kernel.

A text is the set of its character n-grams of 1 to `max_n` characters (blended spectrum, presence only), taken over
lower-cased letters with one space for everything between them. The kernel of two texts is the size of the
intersection, normalised by both sizes. Landmark texts give Nystroem features K(x, landmarks) K(landmarks)^(-1/2), and
one-versus-rest kernel ridge regression on those features gives one score per language. Prediction is two matrix
products per batch; the model is a few megabytes whatever the corpus size.

Regression scores of one text sum to one, so the best of them says which language, not whether it is any. That is
asked of the n-grams themselves: how strange their occurrences are among the fitted rows of a language, from 0 (every
row has them) to 1 (no row has them). The limit of each language comes from its own fitted rows, each held against the
others, and does not depend on how many languages there are or on the length of a text.

The classifier is fitted on at most `per_language` labelled rows of each language, chosen by a hash of the text;
prediction covers every row and whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import stored

MAX_N, BITS = 3, 15
LANDMARKS_PER_LANGUAGE, PER_LANGUAGE, RIDGE = 24, 300, 1e-3
UNKNOWN = "und"
#: Below this score the text is in none of the learned languages; 1 is a typical text of the language, 0 is none.
LEAST_SCORE = 0.25
#: A language's limit of strangeness is twice what all but a hundredth of its fitted rows stay under, within these bounds.
LIMIT_OF_ROWS, LIMIT_TIMES, LEAST_LIMIT, MOST_LIMIT = 0.99, 2.0, 0.25, 0.75
_LETTER = re.compile(r"[^\W\d_]")
_GAPS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
ROWS_PER_PRODUCT = 256


def counts(text: str | None, max_n: int = MAX_N, bits: int = BITS) -> np.ndarray:
    """How often a whole text has each n-gram number, hashed to 2**bits; all zero when it has no letter."""
    if not text or not _LETTER.search(text):
        return np.zeros(1 << bits, np.int64)
    spaced = f" {_GAPS.sub(' ', text.lower()).strip()} "
    code = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    rolling = np.zeros(len(code), np.uint64)
    out = np.zeros(1 << bits, np.int64)
    for n in range(min(max_n, len(code))):
        # one more character to the right: positions i hold the mix of code[i .. i + n]
        rolling = rolling[: len(code) - n] + code[n:] * _MULTIPLIERS[n % 4]
        h = (rolling ^ (rolling >> np.uint64(29))) * _MULTIPLIERS[(n + 1) % 4]
        out += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return out


def ngrams(text: str | None, max_n: int = MAX_N, bits: int = BITS) -> np.ndarray:
    """Which n-gram numbers a whole text has; none when it has no letter."""
    return counts(text, max_n, bits) > 0


def strangeness(having: np.ndarray, rows: np.ndarray | float) -> np.ndarray:
    """0 for an n-gram that all of `rows` rows have, 1 for one that none has; the logarithm of the share between."""
    return np.log((having + 0.5) / (rows + 1)) / np.log(0.5 / (rows + 1))


@dataclass
class KernelModel:
    """Landmark rows, and the weights that turn kernel values into one score per language.

    Landmarks are 0/1 rows over `columns`, the n-gram numbers that any landmark has; others add nothing to a kernel.
    """

    languages: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    max_n: int
    bits: int
    #: Per language: how many fitted rows have an n-gram, how many rows there are, and the limit of strangeness.
    having: np.ndarray
    fitted: np.ndarray
    limits: np.ndarray

    def __post_init__(self) -> None:
        self.strange = strangeness(self.having, self.fitted[:, None]) if len(self.having) else self.having

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """One regression score per language, which sum to one."""
        return self._read(texts)[0]

    def _read(self, texts: list[str | None]) -> tuple[np.ndarray, list[float]]:
        """Regression scores of the texts, and how well each fits the learned languages."""
        rows = np.zeros((len(texts), len(self.columns)), np.float32)
        sizes = np.zeros(len(texts))
        fits = []
        for i, text in enumerate(texts):
            count = counts(text, self.max_n, self.bits)
            at = np.flatnonzero(count)
            rows[i], sizes[i] = count[self.columns] > 0, len(at)
            fits.append(self._fit(at, count[at]) if len(at) else 0.0)
        return _kernel(rows, sizes, self.landmarks, self.norms) @ self.weights + self.bias, fits

    def _fit(self, at: np.ndarray, count: np.ndarray) -> float:
        """1 for a text without a strange n-gram, LEAST_SCORE for one at the limit of the language it fits best."""
        share = (self.strange[:, at] * count).sum(axis=1) / count.sum() / self.limits
        return float(np.clip(1 - (1 - LEAST_SCORE) * share.min(), 0, 1))

    def own_strangeness(self, text: str, language: str) -> float:
        """How strange a fitted row is among the other rows of its language; 1 when there is no other."""
        count = counts(text, self.max_n, self.bits)
        at, i = np.flatnonzero(count), self.languages.index(language)
        return float((strangeness(self.having[i, at] - 1, self.fitted[i] - 1) * count[at]).sum() / count[at].sum())

    def limited(self, own: list[tuple[str, float]]) -> KernelModel:
        """The model with limits from (language, own_strangeness) of its fitted rows."""
        of = {x: [v for y, v in own if y == x] for x in self.languages}
        limits = [LIMIT_TIMES * np.quantile(of[x], LIMIT_OF_ROWS) if of[x] else MOST_LIMIT for x in self.languages]
        return replace(self, limits=np.clip(limits, LEAST_LIMIT, MOST_LIMIT))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language of each text, and how well it fits the learned languages; `und` with score 0 for a text without letters."""
        names, values = [], []
        for at in range(0, len(texts), ROWS_PER_PRODUCT):
            part = texts[at : at + ROWS_PER_PRODUCT]
            if not self.languages:
                names += [UNKNOWN] * len(part)
                values += [0.0] * len(part)
                continue
            score, fits = self._read(part)
            best = score.argmax(axis=1)
            for i, text in enumerate(part):
                known = bool(text and _LETTER.search(text))
                names.append(self.languages[best[i]] if known else UNKNOWN)
                values.append(fits[i] if known else 0.0)
        return names, values


def _kernel(rows: np.ndarray, sizes: np.ndarray, landmarks: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Shared n-grams over the root of the product of both sizes."""
    return (rows @ landmarks.T) / np.sqrt(np.maximum(sizes, 1))[:, None] / norms[None, :]


def fit_rows(rows: np.ndarray, labels: list[str], max_n: int, bits: int, landmarks_per_language: int, ridge: float) -> KernelModel:
    """Ridge regression on Nystroem features of presence rows; the first rows of each language are its landmarks."""
    languages = sorted(set(labels))
    if not languages:
        empty = np.zeros((0, 0), np.float32)
        return KernelModel([], np.zeros(0, np.int64), empty, np.zeros(0), empty, np.zeros(0), max_n, bits, empty, np.zeros(0), np.zeros(0))
    label = np.array(labels)
    chosen = np.concatenate([np.flatnonzero(label == x)[:landmarks_per_language] for x in languages])
    sizes = rows.sum(axis=1)
    having = np.array([rows[label == x].sum(axis=0) for x in languages])
    fitted = np.array([np.count_nonzero(label == x) for x in languages])
    columns = np.flatnonzero(rows[chosen].any(axis=0))
    rows = rows[:, columns]
    landmarks, norms = rows[chosen], np.sqrt(np.maximum(sizes[chosen], 1))
    values, vectors = np.linalg.eigh(_kernel(landmarks, sizes[chosen], landmarks, norms).astype(np.float64))
    large = values > 1e-6 * values.max()
    root = vectors[:, large] / np.sqrt(values[large])
    features = _kernel(rows, sizes, landmarks, norms) @ root
    target = (label[:, None] == np.array(languages)[None, :]).astype(np.float64)
    # each language weighs the same, and the intercept is not penalised
    weight = 1.0 / target.sum(axis=0)[target.argmax(axis=1)]
    weight /= weight.sum()
    mean, middle = weight @ features, weight @ target
    left, right = features - mean, target - middle
    gram = (left * weight[:, None]).T @ left
    solved = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), (left * weight[:, None]).T @ right)
    weights, bias, limits = (root @ solved).astype(np.float32), middle - mean @ solved, np.full(len(languages), MOST_LIMIT)
    return KernelModel(languages, columns, landmarks, norms, weights, bias, max_n, bits, having, fitted, limits)


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    landmarks_per_language: int = LANDMARKS_PER_LANGUAGE,
    max_n: int = MAX_N,
    bits: int = BITS,
    ridge: float = RIDGE,
) -> KernelModel:
    """Fit on at most `per_language` rows of each language (null languages are left out).

    Rows are chosen by the hash of their text, equal texts once. What reaches the driver is one bit per n-gram number
    and row, 2**bits / 8 bytes each, and one number per row for the limits. Without labelled rows the model answers `und`.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = rows.select("lang", F.xxhash64("text").alias("h")).distinct()  # before the ranks, so copies take no places
    first = order.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= per_language)
    mine: dict[str, set[int]] = {}
    for r in first.collect():
        mine.setdefault(r.lang, set()).add(r.h)
    wanted = sorted(set().union(*mine.values()))
    if not wanted:
        return fit_rows(np.zeros((0, 1 << bits), np.float32), [], max_n, bits, landmarks_per_language, ridge)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits_of = [np.packbits(ngrams(t, max_n, bits)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": batch.column(0), "h": batch.column(1), "bits": pa.array(bits_of, pa.binary())})

    known = rows.select("lang", F.xxhash64("text").alias("h"), "text").where(F.col("h").isin(wanted))
    known = stored(known.groupBy("lang", "h").agg(F.min("text").alias("text")))
    got = known.mapInArrow(vectors, "lang string, h long, bits binary").collect()
    kept = sorted((r for r in got if r.h in mine[r.lang]), key=lambda r: (r.h, r.lang))
    dense = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8)) for r in kept], np.float32)
    model = fit_rows(dense, [r.lang for r in kept], max_n, bits, landmarks_per_language, ridge)
    shared = labelled.sparkSession.sparkContext.broadcast((model, mine))

    def strange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mine = shared.value
        for batch in batches:
            rows = [r for r in batch.to_pylist() if r["h"] in mine[r["lang"]]]
            own = [model.own_strangeness(r["text"], r["lang"]) for r in rows]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([r["lang"] for r in rows], pa.string()), "own": pa.array(own, pa.float64())})

    return model.limited([(r.lang, r.own) for r in known.mapInArrow(strange, "lang string, own double").collect()])


def predict(docs: DataFrame, model: KernelModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns plus lang_pred and score of every row. The score says how well the text fits the learned languages.

    A null text, or one without letters, is `und` with score 0. Equal texts get equal answers. An empty table gives
    no rows. Further columns are not read.
    """
    names = [f"c{i}" for i in range(len(keep))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)]
    at = keep.index(text_col) if text_col in keep else len(keep)
    taken = docs.select(*columns, *([F.col(f"`{text_col}`").alias("text")] if at == len(keep) else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few megabytes: landmarks x n-gram numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = shared.value.predict(batch.column(at).to_pylist())
            columns = [*batch.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"{n} {taken.schema[n].dataType.simpleString()}" for n in names)
    out = taken.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "lang_pred", "score")


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo `parts`. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, then predict all: id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col)
    out = predict(docs, model, text_col, (id_col,))
    return out.select(F.col(id_col), held_out(id_col).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows and columns of `docs` whose text has letters and fits a learned language with at least `least_score`.

    The model is learned from the rows that are not held out; nothing but the text decides. Without labelled rows
    there is no model, and no row is accepted.
    """
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col)
    names = tuple(docs.columns)
    inner = [f"d{i}" for i in range(len(names))]  # free of clashes with lang_pred and score
    at = inner[names.index(text_col)]
    out = predict(docs.toDF(*inner), model, at, tuple(inner))
    kept = out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select(*[F.col(n).alias(c) for n, c in zip(inner, names, strict=True)])
