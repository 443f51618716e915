"""Substring deduplication and the Jaccard join against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import docs_frame, sentence
from orderloom.llm import jaccard_join, metric, substring_dedup
from orderloom.llm.graph import components
from orderloom.llm.substring_dedup import remove_repeats
from orderloom.llm.texthash import packed_sorted, unpacked_sorted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeats(rows, size):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_repeats_match_brute_force(spark, odd_rows):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(docs_frame(spark, odd_rows)).collect()]
    assert sorted(got, key=str) == sorted(brute_repeats(odd_rows, 35), key=str)


@pytest.mark.parametrize("size", [2, 3, 7])
def test_small_windows_match_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(i, sentence(rng, rng.randrange(0, 60), ["a", "b", "c"] if i % 3 else None)) for i in range(80)]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(docs_frame(spark, rows), size=size).collect()]
    assert sorted(got) == sorted(brute_repeats(rows, size))


def test_repeat_spans_are_maximal(spark):
    rng = random.Random(1)
    shared = sentence(rng, 50)
    rows = [(1, f"{sentence(rng, 40)} {shared} {sentence(rng, 3)}"), (2, f"new {shared} words")]
    got = {r.doc_id: [tuple(x) for x in r.repeats] for r in remove_repeats(docs_frame(spark, rows)).collect()}
    assert got == {1: [(40, 90)], 2: [(1, 51)]}


@pytest.mark.parametrize("flush", [1, 400, 2_000_000])
def test_repeats_do_not_depend_on_where_batches_end(monkeypatch, flush):
    """One line in every text, the two steps run as a task would: each batch is settled, then all batches meet."""
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    monkeypatch.setattr("orderloom.llm.texthash.CHUNK_BYTES", 500)
    rng, size, block, buckets = random.Random(11), 7, 4, 3
    line = sentence(rng, 12)
    rows = [(i * 2**58 - 2**62, f"{sentence(rng, rng.randrange(0, 9))} {line if i % 4 else ''} {sentence(rng, 8, ['a', 'b'])}") for i in range(30)]
    keys, texts = pa.array([k for k, _ in rows], pa.int64()), pa.array([t for _, t in rows])
    batch = pa.record_batch([keys, keys, texts, pa.array([None] * 30, pa.bool_())], ["k", "d", "t", "c"])
    probed = pa.Table.from_batches(substring_dedup._probe(block, buckets)([batch]))
    groups = [probed.filter(pc.equal(probed["bucket"], b)) for b in set(probed["bucket"].to_pylist())]
    numbers = {}
    for row in itertools.chain.from_iterable(substring_dedup._hit(g).to_pylist() for g in groups):
        numbers.setdefault(row["__row_key"], []).append(row["numbers"])
    batch = pa.record_batch([keys, keys, texts, pa.array([numbers.get(k) for k, _ in rows], pa.list_(pa.binary()))], ["k", "d", "t", "n"])
    grown = pa.Table.from_batches(substring_dedup._windows(block, size, buckets)([batch]))
    groups = [grown.filter(pc.equal(grown["bucket"], b)) for b in set(grown["bucket"].to_pylist())]
    gone = {k: set() for k, _ in rows}
    for row in itertools.chain.from_iterable(substring_dedup._repeated(g).to_pylist() for g in groups):
        for at in np.frombuffer(row["places"], np.uint32).tolist():
            gone[row["__row_key"]].update(range(at, at + size))
    assert [(k, len(gone[k])) for k, _ in rows] == [(k, n) for k, _, n, _ in brute_repeats(rows, size)]


def test_a_line_in_100000_different_texts_adds_one_entry_per_batch():
    n, line = 100_000, np.uint64(0x123456789ABCDEF0)
    rng = np.random.default_rng(3)
    own = rng.integers(0, 2**64, n, dtype=np.uint64)
    key = rng.integers(-(2**63), 2**63, n, dtype=np.int64)
    hot = np.full(n, line)
    probed = substring_dedup._probe_batch([own, hot], [hot], [key], [np.zeros(n, np.int32)], 100)
    assert sum(len(x) for x in probed["row"].to_pylist()) == 0
    assert sum(len(x) for x in probed["sure_row"].to_pylist()) == 8 * n
    assert max(len(x) for x in probed["sure_row"].to_pylist()) < 8 * n / 100 * 1.3
    grown = substring_dedup._window_batch([hot], [hot], [key], [np.zeros(n, np.uint32)], 100)
    assert sum(len(x) for x in grown["h1"].to_pylist()) == 0
    assert sum(len(x) for x in grown["many1"].to_pylist()) == 8
    assert max(len(x) for x in grown["sure_steps"].to_pylist()) < 4 * n / 100 * 1.3


def test_block_must_fit_twice(spark):
    with pytest.raises(ValueError, match="reference block"):
        remove_repeats(docs_frame(spark, [(1, "a")]), size=10, block=6)


@pytest.mark.parametrize("n", [0, 1, 10, 5000])
def test_packed_sets_come_back(n):
    values = np.unique(np.random.default_rng(n).integers(0, 2**36, n, dtype=np.uint64))
    assert (unpacked_sorted(packed_sorted(values)) == values).all()


def brute_sets(rows):
    out = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    return out


def brute_components(rows):
    sets = brute_sets(rows)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(doc, len(sets[i]), least[root(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def test_components_match_brute_force(spark, odd_rows):
    got = [tuple(r) for r in jaccard_join.link_components(docs_frame(spark, odd_rows)).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=str) == sorted(brute_components(odd_rows), key=str)


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(9)
    rows, license_line = [], sentence(rng, 13)
    for g in range(8):
        base = sentence(rng, rng.choice([6, 12, 40, 150])).split()
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(["x", "y", "z"])
            rows.append((len(rows), " ".join(w) + (f" {license_line}" if g % 2 else "")))
    return rows


@pytest.mark.parametrize("region_elements", [60, 400, 4_000_000])
def test_large_regions_lose_no_link(spark, near_rows, region_elements):
    got = jaccard_join.link_components(docs_frame(spark, near_rows), region_elements=region_elements, split_pivots=3)
    got = [tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(brute_components(near_rows))


def test_one_row_of_every_group_stays(spark, odd_rows):
    docs = docs_frame(spark, odd_rows)
    out = jaccard_join.representatives(docs)
    assert out.columns == docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    # a group keeps its smallest id; rows without words stay, equal rows become one
    assert kept[1] == kept[2] == kept[5] == 1 and kept[103] == kept[106] == 0
    assert kept[100] == kept[101] == kept[102] == 1 and kept[105] == 0 and kept[104] == 1 and kept[None] == 1


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_linked_sets_share_a_signature(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    a = np.unique(rng.integers(0, 2**62, n, dtype=np.uint64))
    keep = a[rng.random(len(a)) > rng.choice([0.0, 0.05, 0.1, 0.2])]
    b = np.unique(np.concatenate([keep, rng.integers(0, 2**62, int(rng.integers(0, max(1, n // 8) + 1)), dtype=np.uint64)]))
    both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    if 100 * both < 80 * union or np.array_equal(a, b):
        return
    common = rng.random() * rng.choice([0, 1])
    hidden = set(a[rng.random(len(a)) < common].tolist())
    rows = []
    for x in (a, b):
        left = np.array([v for v in x.tolist() if v not in hidden], np.uint64)
        rows.append(set(jaccard_join.signatures(np.array([len(x)]), np.zeros(len(left), np.int64), left, 80)[1].tolist()))
    assert rows[0] & rows[1]


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**9))
def test_metric_join_matches_all_pairs(seed):
    rng = np.random.default_rng(seed)
    centres = [np.unique(rng.integers(0, 500, int(rng.integers(1, 60)), dtype=np.uint64)) for _ in range(6)]
    sets = []
    for _ in range(120):
        c = centres[int(rng.integers(6))]
        sets.append(np.unique(np.concatenate([c[rng.random(len(c)) > 0.08], rng.integers(0, 500, 2, dtype=np.uint64)])))
    got = metric.linked(sets, 80)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        shared = len(np.intersect1d(sets[i], sets[j]))
        if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    assert got == [root(i) for i in range(len(sets))]


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(200, 100 + i) for i in range(60)] + [(5, 5), (None, 3)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for x in parent}


def test_empty_tables(spark):
    none = docs_frame(spark, [])
    assert remove_repeats(none).count() == 0
    assert jaccard_join.link_components(none).count() == 0
    assert jaccard_join.representatives(none).count() == 0


def test_digest_of_kept_words(spark):
    rows = [(1, "a  b\nc"), (2, None)]
    got = {r.doc_id: hashlib.sha256(r.kept_text.encode()).hexdigest() for r in remove_repeats(docs_frame(spark, rows)).collect()}
    assert got == {1: hashlib.sha256(b"a b c").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
