"""Exact Jaccard similarity join of word-shingle sets in metric space.

Jaccard distance is a metric, so pivots and the triangle inequality split the work: a set goes to the Voronoi cell of
its nearest pivot, and to every other cell in which it could have a partner (see `metric.divide`), recursively.
Unrelated texts, however, are all at distance 1 from every pivot, where no triangle inequality separates them. The
corpus is therefore first cut into regions of texts that agree somewhere, without losing any pair:

* Sets with 100 * intersection >= 80 * union differ in at most a ninth of both sizes together. Hash the elements into
  more parts than that: one part at least is equal in both. Part counts depend on a size class only, and a set also
  emits the parts of the class above its own, so sets of different sizes meet. A set has more parts of two elements or
  more than it can differ in, so one of those is equal too, and only those are emitted: one shared element alone brings
  no texts together. A set that has too few of them emits parts of one element as well, and if need be empty ones.
* Texts with an equal part are connected, by stars rather than pairs, and the connected components are the regions.
  Two sets that link are always in one region.

Equal sets are one representative throughout. A region of at most `region_elements` set elements is joined in one task; a larger
one is first cut by pivots of its own in Spark (`_split`), and where even that does not shrink it (very many texts at
the same distance from each other) it is joined in blocks of bounded size. Regions never come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.llm.metric import linked
from orderloom.llm.rows import KEY, buckets_for, keyed, text_bytes
from orderloom.llm.texthash import (
    SET_BITS,
    Words,
    bucket_of,
    cuts,
    joined,
    mixed,
    packed_sorted,
    unpacked_sorted,
    word_chunks,
)
from orderloom.session import stored

SHINGLE, PERCENT = 5, 80
REGION_ELEMENTS, SPLIT_PIVOTS, SPLIT_ROUNDS, COMMON_SHARE = 4_000_000, 16, 6, 0.002
FLUSH = 1_200_000
SHRINK = 0.7
_LOW = np.uint64(2**SET_BITS - 1)


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted; a row of fewer words has all of them as one."""
    room, row = w.room(), w.row_of_word()
    full = np.flatnonzero(room >= size)
    hashes, rows = [w.windows(size)[full]], [row[full]]
    count = np.diff(w.offsets)
    for n in range(1, size):
        first = w.offsets[:-1][count == n]
        if len(first):
            # a multiplier of its own keeps short sequences apart from shingles
            hashes.append(mixed(w.windows(n)[first] * np.uint64(2 * n + 1)))
            rows.append(row[first])
    h, r = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[new], h[new]


def size_classes(most: int, percent: int) -> np.ndarray:
    """Largest size of each class; a class reaches down to percent of its largest size."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return np.array(tops, np.int64)


def parts_of(top: np.ndarray, percent: int) -> np.ndarray:
    """Parts for a class: more than the sets of the class can differ in, with room for empty parts."""
    differing = 2 * top * (100 - percent) / (100 + percent)  # of a pair of the largest size
    return np.ceil(differing * 1.71 + 1.5).astype(np.int64)


def signatures(size: np.ndarray, row: np.ndarray, h: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) such that two sets that link share at least one, unless both are equal.

    `size` has the full size of every row's set. `row` and `h` may lack elements, as long as all rows lack the same:
    that lets two sets differ in fewer elements, never in more.
    """
    tops = size_classes(2 * int(size.max(initial=0)) + 2, percent)
    own = np.searchsorted(tops, size)
    # a partner differs in at most this many elements, and so in at most as many parts; 0: it must be equal
    most = size * (100 - percent) // percent
    out_row, out_sig = [], []
    for above in (0, 1):
        number = own + above
        parts = np.where(most >= 1, parts_of(tops[number], percent), 0)
        base = np.concatenate([[0], np.cumsum(parts)])
        seen = parts[row] > 0
        at, value = row[seen], h[seen]
        spread = mixed(value + number.astype(np.uint64)[at] * np.uint64(0x9E3779B97F4A7C15))
        part = base[at] + ((spread >> np.uint64(32)) * parts.astype(np.uint64)[at] >> np.uint64(32)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, part, mixed(spread + np.uint64(1)))
        count = np.bincount(part, minlength=base[-1])
        owner = np.repeat(np.arange(len(size)), parts)
        inside = np.arange(base[-1]) - base[owner]
        emit = count >= 2
        for least in (1, 0):
            present = np.bincount(owner, emit, minlength=len(size))
            emit |= (count >= least) & (present <= most)[owner]
        label = number.astype(np.uint64)[owner] * np.uint64(0xD6E8FEB86659FD93) + inside.astype(np.uint64)
        out_row.append(owner[emit])
        out_sig.append(mixed(total[emit] ^ mixed(label[emit])))
    return np.concatenate(out_row), np.concatenate(out_sig)


def _frequent(shingle: int, share: float):
    """Column: text. (element, texts) of elements that at least `share` of the texts of a stretch have."""

    def stretch(held: list[np.ndarray], texts: int) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= max(8, share * texts)
        return pa.RecordBatch.from_pydict({"h": h[often].view(np.int64), "n": n[often].astype(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, n = [], 0, 0
        for batch in batches:
            for w in word_chunks(batch.column(0), lower=True):
                held.append(shingle_sets(w, shingle)[1])
                texts, n = texts + len(w.offsets) - 1, n + len(held[-1])
                if n >= 2 * FLUSH:
                    yield stretch(held, texts)
                    held, texts, n = [], 0, 0
        if n:
            yield stretch(held, texts)

    return run


def frequent_elements(rows: DataFrame, shingle: int, share: float) -> np.ndarray:
    """Elements that about `share` of all texts have, such as those of a common line; sorted.

    They are left out of signatures, else texts would meet for a common line alone. Which elements are found changes
    the work, never the result. There are at most (mean set size / share) of them, eight bytes each.
    """
    found = rows.select("text").mapInArrow(_frequent(shingle, share), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    least = max(8, share * rows.count())
    return np.sort(np.array([r.h for r in found.where(F.col("n") >= least).select("h").collect()], np.int64).view(np.uint64))


def _batch(sigs: list, keys: list, docs: list, buckets: int) -> pa.RecordBatch:
    """Signatures once each with the smallest key that has them; the other keys as edges to that one."""
    sig, key = np.concatenate(sigs), np.concatenate(keys)
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    least = key[new][np.cumsum(new) - 1]
    other = key != least
    edges = np.unique(np.stack([key[other], least[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    sig, key = sig[new], key[new]
    at = cuts(bucket_of(sig, buckets), buckets)
    names = np.unique(key)
    number = np.searchsorted(names, key).astype(np.uint32)
    doc = np.concatenate(docs)  # key, size and two hashes of each row
    edge_at = np.linspace(0, len(edges), buckets + 1).astype(int)
    doc_at = np.linspace(0, len(doc), buckets + 1).astype(int)
    packs, rows_of, refs = [], [], []
    for i in range(buckets):
        part, owner = sig[at[i] : at[i + 1]] & _LOW, number[at[i] : at[i + 1]]
        by = np.argsort(part, kind="stable")
        used, ref = np.unique(owner[by], return_inverse=True)
        packs.append(packed_sorted(part[by]))
        rows_of.append(names[used].astype("<i8").tobytes())
        refs.append(ref.astype("<u2" if len(used) < 65536 else "<u4").tobytes())
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(range(buckets), pa.int64()),
            "sigs": pa.array(packs, pa.binary()),
            "rows": pa.array(rows_of, pa.binary()),
            "refs": pa.array(refs, pa.binary()),
            "edges": pa.array([edges[edge_at[i] : edge_at[i + 1]].astype("<i8").tobytes() for i in range(buckets)], pa.binary()),
            "docs": pa.array([doc[doc_at[i] : doc_at[i + 1]].astype("<i8").tobytes() for i in range(buckets)], pa.binary()),
        }
    )


def _emit(shingle: int, percent: int, buckets: int, common):  # noqa: ANN001
    """Columns: key, text. `common` is a broadcast sorted array of elements to leave out of signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], []), 0
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for w in word_chunks(batch.column(1), lower=True):
                mine = key[w.rows]
                row, h = shingle_sets(w, shingle)
                size = np.bincount(row, minlength=len(mine))
                prints = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    total = np.zeros(len(mine), np.uint64)
                    np.add.at(total, row, mixed(h + np.uint64(salt)))
                    prints.append(total.view(np.int64))
                rare = ~_among(h, common.value)
                sig_row, sig = signatures(size, row[rare], h[rare], percent)
                held[0].append(sig)
                held[1].append(mine[sig_row])
                held[2].append(np.stack([mine, size, *prints], axis=1))
                n += len(sig) + len(mine)
                if n >= FLUSH:
                    yield _batch(*held, buckets)
                    held, n = ([], [], []), 0
        if held[2]:
            yield _batch(*held, buckets)

    return run


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _meet(table: pa.Table) -> pa.Table:
    """One bucket: edges between keys with equal signatures, and the rows about texts passed on."""
    sigs, keys = [], []
    for raw, names, refs in zip(*(table[c].to_pylist() for c in ("sigs", "rows", "refs")), strict=True):
        part, rows = unpacked_sorted(raw), np.frombuffer(names, "<i8")
        sigs.append(part)
        keys.append(rows[np.frombuffer(refs, "<u2" if len(refs) == 2 * len(part) else "<u4")])
    sig, key = np.concatenate(sigs), np.concatenate(keys)
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    least = key[new][np.cumsum(new) - 1] if len(sig) else key
    other = key != least
    edges = np.concatenate([np.stack([key[other], least[other]], axis=1), joined(table["edges"], "<i8").reshape(-1, 2)])
    edges = np.unique(edges, axis=0)
    docs = joined(table["docs"], "<i8").reshape(-1, 4)
    none = pa.nulls(len(edges), pa.int64())
    return pa.concat_tables(
        [
            pa.table({"a": edges[:, 0], "b": edges[:, 1], "f1": none, "f2": none, "edge": np.ones(len(edges), bool)}),
            pa.table({"a": docs[:, 0], "b": docs[:, 1], "f1": docs[:, 2], "f2": docs[:, 3], "edge": np.zeros(len(docs), bool)}),
        ]
    )


def _sets(shingle: int):
    """Columns: key, region, text. Adds the set as sorted 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[bytes] = []
            for w in word_chunks(batch.column(2), lower=True):
                row, h = shingle_sets(w, shingle)
                edges = np.searchsorted(row, np.arange(w.rows.stop - w.rows.start + 1))
                sets += [h[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=[KEY, "region", "elements"])

    return run


def _arrays(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    return table[KEY].to_numpy(), [np.frombuffer(x, np.uint64) for x in table["elements"].to_pylist()]


def _join_region(percent: int):
    def run(table: pa.Table) -> pa.Table:
        key, sets = _arrays(table)
        root = np.array(linked(sets, percent), np.int64)
        other = key != key[root]
        return pa.table({"a": key[other], "b": key[root[other]]})

    return run


def _split(sets: DataFrame, percent: int, pivots: int, most: int) -> tuple[DataFrame, DataFrame]:
    """One step for regions too large for a task: (sets with their new regions, links found on the way).

    Every region takes `pivots` sets as pivots and is dealt into chunks; each chunk meets a copy of the pivots, so no
    task holds a region. A set goes to the cell of its nearest pivot and to each cell within twice the radius.
    """
    radius = 2 * (100 - percent) / 100
    sizes = sets.groupBy("region").agg(F.expr("sum(octet_length(elements) div 8)").alias("n"))
    order = Window.partitionBy("region").orderBy(F.xxhash64(KEY), KEY)
    chosen = sets.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pivots).drop("rank")
    n_chunks = F.ceil(F.col("n") / most)
    dealt = sets.join(sizes, "region").withColumn("chunk", F.pmod(F.xxhash64(KEY), n_chunks.cast("long")))
    copied = chosen.join(sizes, "region").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks.cast("long") - 1)))
    copied = stored(copied.select("region", "chunk", KEY, "elements"))

    def run(docs: pa.Table, near: pa.Table) -> pa.Table:
        key, values = _arrays(docs)
        names, centres = _arrays(near)
        region = docs["region"][0].as_py() if len(docs) else 0
        distance = np.ones((len(centres), len(values)))
        for j, c in enumerate(centres):
            for i, v in enumerate(values):
                both = len(np.intersect1d(c, v, assume_unique=True))
                distance[j, i] = 1 - both / max(len(c) + len(v) - both, 1)
        nearest = distance.min(axis=0) if len(centres) else np.zeros(len(values))
        j, i = np.nonzero(distance <= nearest[None, :] + radius)
        cells = mixed(np.uint64(region % 2**64) ^ mixed(names[j].astype(np.uint64))).astype(np.int64)
        p, q = np.nonzero(distance <= (100 - percent) / 100 + 1e-12)
        none = pa.nulls(len(p), pa.binary())
        elements = docs["elements"].combine_chunks().take(pa.array(i))
        return pa.concat_tables(
            [
                pa.table({KEY: key[i], "region": cells, "elements": elements}),
                pa.table({KEY: key[q], "region": names[p], "elements": none}),
            ]
        )

    dealt = dealt.select("region", "chunk", KEY, "elements")
    parts = dealt.groupBy("region", "chunk").cogroup(copied.groupBy("region", "chunk"))
    out = stored(parts.applyInArrow(run, f"{KEY} long, region long, elements binary"))
    links = out.where("elements is null").select(F.col(KEY).alias("a"), F.col("region").alias("b"))
    return out.where("elements is not null"), links


def _blocks(sets: DataFrame, most: int) -> DataFrame:
    """Every pair of blocks of a region as a region of its own, for regions that pivots cannot cut."""
    sizes = sets.groupBy("region").agg(F.ceil(2 * F.expr("sum(octet_length(elements) div 8)") / most).cast("long").alias("blocks"))
    mine = sets.join(sizes, "region").withColumn("block", F.pmod(F.xxhash64(KEY, F.lit(7)), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("blocks") - 1, F.lit(1))))
    paired = mine.withColumn("other", other).where("blocks = 1 or other != block")
    region = F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other"))
    return paired.select(KEY, region.alias("region"), "elements").distinct()


def _large(sets: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """Sets of regions of at most `most` elements, those of larger ones, and the elements of the largest region."""
    sizes = sets.groupBy("region").agg(F.expr("sum(octet_length(elements) div 8)").alias("n"))
    large = sizes.where(F.col("n") > most)
    biggest = large.agg(F.max("n")).first()[0] or 0
    if not biggest:
        return sets, sets.limit(0), 0
    large = large.select("region")
    return sets.join(large, "region", "left_anti"), sets.join(large, "region", "left_semi"), biggest


def link_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    region_elements: int = REGION_ELEMENTS,
    split_pivots: int = SPLIT_PIVOTS,
    share: float = COMMON_SHARE,
) -> DataFrame:
    """One row per input row: key, id, n_shingles, component_id, set_root.

    Texts are lower-cased (A-Z) and cut into words; a text's set is its distinct shingles of `shingle` words, or the
    whole sequence when it is shorter. Rows link when 100 * intersection >= percent * union; component_id is the
    smallest id reachable by links, null ids aside. Null texts and texts without words have no shingles, link with
    nothing and keep their own id. Equal rows link. An empty table gives no rows; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    buckets = buckets_for(text_bytes(docs, text_col))
    common = docs.sparkSession.sparkContext.broadcast(frequent_elements(rows, shingle, share))
    emitted = rows.select(KEY, "text").mapInArrow(
        _emit(shingle, percent, buckets, common), "bucket long, sigs binary, rows binary, refs binary, edges binary, docs binary"
    )
    met = stored(emitted.groupBy("bucket").applyInArrow(_meet, "a long, b long, f1 long, f2 long, edge boolean"))
    texts = met.where("not edge").groupBy(F.col("a").alias(KEY)).agg(F.max("b").alias("n"), F.max("f1").alias("f1"), F.max("f2").alias("f2"))
    # equal sets: one representative each
    groups = texts.where("n > 0").groupBy("n", "f1", "f2").agg(F.min(KEY).alias("rep"))
    texts = stored(texts.join(groups, ["n", "f1", "f2"], "left").select(KEY, "n", "rep"))
    same = texts.where(F.col(KEY) != F.col("rep")).select(F.col(KEY).alias("a"), F.col("rep").alias("b"))
    regions = components(met.where("edge").select("a", "b").union(same))
    # a region with one representative has no other sets to compare
    members = texts.where(F.col(KEY) == F.col("rep")).join(regions.select(F.col("node").alias(KEY), F.col("root").alias("region")), KEY)
    shared = members.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("sets")).where("sets > 1")
    members = stored(members.join(shared, "region").select(KEY, "region", "weight"))

    def sets_of(some: DataFrame) -> DataFrame:
        # a shuffle at every size: members grow with the corpus, and are no side to broadcast
        joined = rows.select(KEY, "text").join(some.select(KEY, "region").hint("merge"), KEY).select(KEY, "region", "text")
        return joined.mapInArrow(_sets(shingle), f"{KEY} long, region long, elements binary")

    links = stored(_region_links(sets_of(members.where(F.col("weight") <= region_elements)), percent))
    if members.where(F.col("weight") > region_elements).limit(1).count():
        large = stored(sets_of(members.where(F.col("weight") > region_elements)))
        links = links.union(_large_links(large, percent, region_elements, split_pivots, share))
    roots = components(links).select(F.col("node").alias("rep"), F.col("root").alias("top"))
    placed = texts.join(roots, "rep", "left").select(KEY, "n", F.coalesce("top", "rep", KEY).alias("set_root"))
    ids = rows.select(KEY, "doc_id").join(placed, KEY)
    least = ids.groupBy("set_root").agg(F.min("doc_id").alias("component_id"))
    out = ids.join(least, "set_root")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(KEY, F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"), "set_root")


def _large_links(sets: DataFrame, percent: int, most: int, split_pivots: int, share: float) -> DataFrame:
    """Edges that connect whatever links, for regions too large for a task.

    They are first cut by signatures without the elements common in the region itself, then by pivots, each while it
    makes the largest region smaller, and at last joined in blocks.
    """
    links: list[DataFrame] = []
    large, biggest = sets, None
    for step in ("refine", "split"):
        for _ in range(SPLIT_ROUNDS):
            if biggest == 0:
                break
            if step == "refine":
                cut = _refine(large, percent, share)
            else:
                cut, found = _split(large, percent, split_pivots, most)
                links.append(found)
            before = biggest
            small, large, biggest = _large(cut, most)
            links.append(_region_links(small, percent))
            if before and biggest > SHRINK * before:
                break
    if biggest:
        links.append(_region_links(_blocks(large, most), percent))
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _refine(sets: DataFrame, percent: int, share: float) -> DataFrame:
    """New regions inside regions, by signatures without the elements that `share` of a region's sets have."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = batch.column(0).to_numpy(zero_copy_only=False)
            values = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            each = np.repeat(region, [len(v) for v in values])
            yield pa.RecordBatch.from_pydict({"region": each, "h": np.concatenate([*values, np.zeros(0, np.int64)])})

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, region = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rare, size = [], []
            for raw, common in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                h = np.frombuffer(raw, np.uint64)
                size.append(len(h))
                rare.append(h[~np.isin(h, np.array(common or [], np.int64).view(np.uint64))])
            row = np.repeat(np.arange(len(rare)), [len(x) for x in rare])
            at, sig = signatures(np.array(size, np.int64), row, np.concatenate([*rare, np.zeros(0, np.uint64)]), percent)
            yield pa.RecordBatch.from_pydict({"region": region[at], "sig": sig.view(np.int64), KEY: key[at]})

    sizes = sets.groupBy("region").agg(F.count("*").alias("all"))
    counted = sets.select("region", "elements").mapInArrow(elements, "region long, h long").groupBy("region", "h").agg(F.count("*").alias("n"))
    common = counted.join(sizes, "region").where((F.col("n") >= 8) & (F.col("n") >= share * F.col("all")))
    common = common.groupBy("region").agg(F.collect_list("h").alias("common"))  # at most mean set size / share
    signed = sets.join(common, "region", "left").select(KEY, "region", "elements", "common")
    signed = stored(signed.mapInArrow(sign, f"region long, sig long, {KEY} long"))
    least = signed.groupBy("region", "sig").agg(F.min(KEY).alias("b"), F.count("*").alias("n")).where("n > 1")
    edges = signed.join(least, ["region", "sig"]).select(F.col(KEY).alias("a"), "b")
    roots = components(edges).select(F.col("node").alias(KEY), F.col("root").alias("region"))
    return stored(sets.drop("region").join(roots, KEY).select(KEY, "region", "elements"))


def _region_links(sets: DataFrame, percent: int) -> DataFrame:
    return sets.groupBy("region").applyInArrow(_join_region(percent), "a long, b long")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """`docs` with one row of every group of linked rows: that with the smallest id (nulls last), then key."""
    found = link_components(docs, id_col, text_col, **options)
    grouped = F.when(F.col("n_shingles") > 0, F.col("set_root")).otherwise(F.col(KEY))
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(KEY).alias("k"))
    best = found.groupBy(grouped.alias("g")).agg(F.min(place).alias("best")).select(F.col("best.k").alias(KEY))
    names = docs.columns
    marked = docs.withColumn(KEY, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))).join(best, KEY, "left_semi")
    return marked.select(*[F.col(f"`{c}`") for c in names], KEY).dropDuplicates([KEY]).drop(KEY)
