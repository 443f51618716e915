"""Exact substring deduplication with fixed-block anchors.

Every text is cut into non-overlapping reference blocks of `block` words, the index. All rolling windows of the same
size probe that index. A window of `size` >= 2 * block - 1 words always holds one whole reference block of its own
text, so a repeated window has a reference block that at least two probes hit. From each such hit the windows around
the block are grown to `size` words, and those whose full word sequence occurs twice are repeats; their union is the
set of maximal exact repeats.

Equal texts are counted first and only one of them goes on. Shuffled data: the texts once (three joins share that
exchange), three to four bytes per rolling window (repeats inside a task are merged), one reference per block, and for
windows around hit blocks a 96-bit hash with a reference. Nothing is formed per pair of texts, so thousands of copies
cost as much as as many different texts.

Hashes meet in buckets, each a group of one task. What occurs twice within a batch of FLUSH windows is known to be
repeated there and then: its places are dealt by document, and its bucket gets the hash alone, once. So a passage that a
third of all different texts share adds at most one entry per batch to a group, however many texts hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import KEY, buckets_for, copies, keyed, text_bytes
from orderloom.llm.texthash import (
    SET_BITS,
    Words,
    bucket_of,
    cuts,
    joined,
    packed,
    packed_sorted,
    unpacked,
    unpacked_sorted,
    word_chunks,
)

SIZE, BLOCK = 35, 18
FLUSH = 2_000_000
_LOW = np.uint64(2**SET_BITS - 1)
_PROBED = "bucket long, once binary, often binary, block binary, row binary, number binary, sure_row binary, sure_number binary"
_GROWN = "bucket long, " + ", ".join(
    f"{c} binary" for c in ("h1", "h2", "many1", "many2", "rows", "lengths", "steps", "sure_rows", "sure_lengths", "sure_steps")
)


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket that keeps the order inside, and where buckets begin."""
    bucket = bucket_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, cuts(bucket[order], buckets)


def _by_document(key: np.ndarray, place: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and places ordered by a bucket of the document, and where buckets begin."""
    order, edges = _by_bucket(key.astype(np.int64).view(np.uint64), buckets)
    return key[order], place[order], edges


def _probe_batch(probes: list, blocks: list, keys: list, numbers: list, buckets: int) -> pa.RecordBatch:
    hashes, count = np.unique(np.concatenate(probes), return_counts=True)  # sorted, so by bucket
    edges = cuts(bucket_of(hashes, buckets), buckets)
    block, key, number = np.concatenate(blocks), np.concatenate(keys), np.concatenate(numbers)
    sure = count[np.searchsorted(hashes, block)] > 1  # a block is a window of its batch, too
    sure_key, sure_number, sure_at = _by_document(key[sure], number[sure], buckets)
    block, key, number = block[~sure], key[~sure], number[~sure]
    order, at = _by_bucket(block, buckets)
    block, key, number = block[order] & _LOW, key[order], number[order]
    full = [i for i in range(buckets) if edges[i + 1] > edges[i] or sure_at[i + 1] > sure_at[i]]
    once, often = [], []
    for i in full:
        part, n = hashes[edges[i] : edges[i + 1]] & _LOW, count[edges[i] : edges[i + 1]]
        once.append(packed_sorted(np.sort(part[n == 1])))
        often.append(packed_sorted(np.sort(part[n > 1])))
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(full, pa.int64()),
            "once": pa.array(once, pa.binary()),
            "often": pa.array(often, pa.binary()),
            "block": pa.array([packed(block[at[i] : at[i + 1]], 5) for i in full], pa.binary()),
            "row": pa.array([key[at[i] : at[i + 1]].tobytes() for i in full], pa.binary()),
            "number": pa.array([number[at[i] : at[i + 1]].tobytes() for i in full], pa.binary()),
            "sure_row": pa.array([sure_key[sure_at[i] : sure_at[i + 1]].tobytes() for i in full], pa.binary()),
            "sure_number": pa.array([sure_number[sure_at[i] : sure_at[i + 1]].tobytes() for i in full], pa.binary()),
        }
    )


def _probe(block: int, buckets: int):
    """Columns: key, id, text, copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], [], []), 0
        for batch in batches:
            batch = batch.filter(pa.compute.invert(pa.compute.fill_null(batch.column(3), False)))
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for w in word_chunks(batch.column(2)):
                fits = w.room() >= block
                window = w.windows(block)
                place = np.arange(len(w.hashes)) - np.repeat(w.offsets[:-1], np.diff(w.offsets))
                anchor = fits & (place % block == 0)
                held[0].append(window[fits])
                held[1].append(window[anchor])
                held[2].append(key[w.rows][w.row_of_word()[anchor]])
                held[3].append((place[anchor] // block).astype(np.int32))
                n += int(fits.sum())
                if n >= FLUSH:
                    yield _probe_batch(*held, buckets)
                    held, n = ([], [], [], []), 0
        if n:
            yield _probe_batch(*held, buckets)

    return run


def _hit(table: pa.Table) -> pa.Table:
    """Reference blocks that two probes hit: those of one bucket of hashes, and those that their batch has settled."""
    once = np.sort(np.concatenate([unpacked_sorted(x) for x in table["once"].to_pylist()]))
    often = np.concatenate([unpacked_sorted(x) for x in table["often"].to_pylist()])
    # what is seen once by two tasks, or often by any; a value seen once here and often there is in `often` already
    often = np.union1d(often, once[1:][once[1:] == once[:-1]])
    block = unpacked(b"".join(table["block"].to_pylist()), 5)
    found = np.isin(block, often)
    row = np.concatenate([joined(table["row"], "<i8")[found], joined(table["sure_row"], "<i8")])
    number = np.concatenate([joined(table["number"], "<i4")[found], joined(table["sure_number"], "<i4")])
    order = np.lexsort((number, row))
    row, number = row[order], number[order]
    rows, first = np.unique(row, return_index=True)
    parts = [x.tobytes() for x in np.split(number, first[1:])] if len(rows) else []
    return pa.table({KEY: pa.array(rows, pa.int64()), "numbers": pa.array(parts, pa.binary())})


def _grown(w: Words, lists: list, block: int, size: int) -> np.ndarray:
    """Positions of the windows of `size` words that hold a hit block of their own row."""
    here = np.zeros(len(w.hashes) + 1, np.int64)
    for i, parts in enumerate(lists):
        if parts:
            lo, hi = w.offsets[i], w.offsets[i + 1]
            at = np.concatenate([np.frombuffer(p, np.int32) for p in parts]).astype(np.int64) * block + lo
            at = at[at + block <= hi]
            np.add.at(here, np.maximum(at - (size - block), lo), 1)
            np.add.at(here, at + 1, -1)
    return np.flatnonzero((np.cumsum(here)[:-1] > 0) & (w.room() >= size))


def _steps(key: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Places of rows that stand together: each row once, its number of places, and the places as steps."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(first, len(key)))
    return key[first].tobytes(), lengths.astype("<u4").tobytes(), np.diff(place, prepend=np.uint32(0)).astype("<u4").tobytes()


def _places(table: pa.Table, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Keys and places as `_steps` has written them."""
    key = np.repeat(joined(table[f"{prefix}rows"], "<i8"), joined(table[f"{prefix}lengths"], "<u4"))
    each = [np.cumsum(np.frombuffer(x, "<u4"), dtype=np.uint32) for x in table[f"{prefix}steps"].to_pylist()]
    return key, np.concatenate(each)


def _window_batch(a: list, b: list, keys: list, places: list, buckets: int) -> pa.RecordBatch:
    h1, h2, key, place = (np.concatenate(x) for x in (a, b, keys, places))
    h2 &= np.uint64(2**32 - 1)
    order = np.lexsort((h2, h1))
    s1, s2 = h1[order], h2[order]
    first = np.flatnonzero(np.concatenate([[True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])]))
    count = np.diff(np.append(first, len(order)))
    sure = np.empty(len(order), bool)
    sure[order] = np.repeat(count > 1, count)
    many1, many2 = s1[first[count > 1]], s2[first[count > 1]]  # sorted, so by bucket
    many_at = cuts(bucket_of(many1, buckets), buckets)
    sure_key, sure_place, sure_at = _by_document(key[sure], place[sure], buckets)
    h1, h2, key, place = h1[~sure], h2[~sure], key[~sure], place[~sure]
    order, at = _by_bucket(h1, buckets)
    h1, h2, key, place = h1[order], h2[order], key[order], place[order]
    full = [i for i in range(buckets) if any(x[i + 1] > x[i] for x in (at, many_at, sure_at))]
    one = [_steps(key[at[i] : at[i + 1]], place[at[i] : at[i + 1]]) for i in full]
    known = [_steps(sure_key[sure_at[i] : sure_at[i + 1]], sure_place[sure_at[i] : sure_at[i + 1]]) for i in full]
    columns = {
        "h1": [h1[at[i] : at[i + 1]].tobytes() for i in full],
        "h2": [packed(h2[at[i] : at[i + 1]], 4) for i in full],
        "many1": [many1[many_at[i] : many_at[i + 1]].tobytes() for i in full],
        "many2": [packed(many2[many_at[i] : many_at[i + 1]], 4) for i in full],
    }
    for prefix, parts in (("", one), ("sure_", known)):
        for n, name in enumerate(("rows", "lengths", "steps")):
            columns[prefix + name] = [x[n] for x in parts]
    return pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int64())} | {c: pa.array(v, pa.binary()) for c, v in columns.items()})


def _windows(block: int, size: int, buckets: int):
    """Columns: key, id, text, numbers of the hit blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], [], []), 0
        for batch in batches:
            batch = batch.filter(pa.compute.is_valid(batch.column(3)))
            key, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(3).to_pylist()
            for w in word_chunks(batch.column(2)):
                at = _grown(w, lists[w.rows], block, size)
                row = w.row_of_word()[at]
                held[0].append(w.windows(size)[at])
                held[1].append(w.windows(size, 1)[at])
                held[2].append(key[w.rows][row])
                held[3].append((at - w.offsets[row]).astype(np.uint32))
                n += len(at)
                if n >= FLUSH // 2:
                    yield _window_batch(*held, buckets)
                    held, n = ([], [], [], []), 0
        if n:
            yield _window_batch(*held, buckets)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Windows whose word sequence occurs more than once, by row: of one bucket of hashes, and those settled before."""
    h1 = np.concatenate([joined(table["h1"], "<u8"), joined(table["many1"], "<u8")])
    h2 = np.concatenate([unpacked(b"".join(table[c].to_pylist()), 4) for c in ("h2", "many2")])
    key, place = _places(table)
    order = np.lexsort((h2, h1))
    same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    found = np.zeros(len(h1), bool)
    found[order[1:]] |= same
    found[order[:-1]] |= same
    found = found[: len(key)]  # the others are hashes whose places are settled
    sure_key, sure_place = _places(table, "sure_")
    key, place = np.concatenate([key[found], sure_key]), np.concatenate([place[found], sure_place])
    by = np.argsort(key, kind="stable")
    rows, first = np.unique(key[by], return_index=True)
    parts = [x.tobytes() for x in np.split(place[by], first[1:])] if len(rows) else []
    return pa.table({KEY: pa.array(rows, pa.int64()), "places": pa.array(parts, pa.binary())})


def _kept(size: int):
    """Columns: key, id, text, copy, places of the repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal, lists = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            n_words, n_removed, kept_texts, spans = [], [], [], []
            for w in word_chunks(batch.column(2)):
                raw = w.data.tobytes()
                for i, parts in enumerate(lists[w.rows]):
                    lo, hi = w.offsets[i], w.offsets[i + 1]
                    cover = np.zeros(hi - lo + 1, np.int64)
                    for p in parts or ():
                        at = np.frombuffer(p, np.uint32).astype(np.int64)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size, -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    if equal[w.rows.start + i] is not None and hi - lo >= size:
                        gone[:] = True  # every window also starts in the equal text
                    stay = np.flatnonzero(~gone) + lo
                    text = b" ".join([raw[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist(), strict=True)])
                    step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                    n_words.append(int(hi - lo))
                    n_removed.append(int(gone.sum()))
                    kept_texts.append(text.decode("utf-8", "replace"))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(1),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_text": pa.array(kept_texts, pa.string()),
                    "repeats": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                }
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, block: int | None = None) -> DataFrame:
    """Remove every word of a window of `size` words whose word sequence also starts elsewhere in the corpus.

    Returns one row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one
    space) and repeats (word spans of the maximal repeats, end exclusive). A null or empty text has no words, a text
    of fewer than `size` words loses none, a repeated row counts as another place, an empty table gives no rows, and
    further input columns are not read.
    """
    block = block or (size + 1) // 2
    if 2 * block - 1 > size:
        raise ValueError("a window must hold a whole reference block: 2 * block - 1 <= size")
    buckets = buckets_for(text_bytes(docs, text_col))
    rows = keyed(docs, id_col, text_col)
    equal = copies(rows)
    # the same columns of `rows` in all three joins, so that Spark shuffles the texts once
    some = rows.join(equal, KEY, "left").select(KEY, "doc_id", "text", "copy")
    probes = some.mapInArrow(_probe(block, buckets), _PROBED)
    hits = probes.groupBy("bucket").applyInArrow(_hit, f"{KEY} long, numbers binary")
    hits = hits.groupBy(KEY).agg(F.collect_list("numbers").alias("numbers"))
    tried = rows.join(hits, KEY, "left").select(KEY, "doc_id", "text", "numbers")
    grown = tried.mapInArrow(_windows(block, size, buckets), _GROWN)
    repeated = grown.groupBy("bucket").applyInArrow(_repeated, f"{KEY} long, places binary")
    repeated = repeated.groupBy(KEY).agg(F.collect_list("places").alias("places"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.join(equal, KEY, "left")
        .join(repeated, KEY, "left")
        .select(KEY, "doc_id", "text", "copy", "places")
        .mapInArrow(
            _kept(size),
            f"doc_id {kind}, n_words long, n_removed long, kept_text string, repeats array<struct<start:int,end:int>>",
        )
    )
