"""Mixing, URLs, decontamination, archives and the pipeline."""

import base64
import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import docs_frame, sentence
from orderloom.llm import arc_warc, decontaminate, language_id, mixing, secret_scan, url_filter
from llm.test_texts import brute_components

DATA = "/root/testdata/sf0.001"


# --- mixing ---------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def targets(spark, sizes, *options):
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    return {r.source: r.target for r in mixing.shares(table, *options).collect()}


def test_targets_reshare_what_is_full(spark):
    got = targets(spark, {"b": 10, "a": 1000, None: 5, "c": 985})
    assert got["b"] == 30 and got[None] == 15
    assert got["a"] == pytest.approx(1955 / 4) and got["c"] == pytest.approx(3 * 1955 / 4)
    assert targets(spark, {}) == {} and targets(spark, {"a": 0, "b": 0}) == {"a": 0.0, "b": 0.0}
    assert targets(spark, {"a": 7, None: 3}, (1,), 0.5) == {"a": 3.5, None: 1.5}  # all full


@pytest.mark.parametrize("seed", range(3))
def test_targets_of_many_sources_match_plain_python(spark, seed):
    rng = random.Random(seed)
    sizes = {f"host{rng.randrange(10**6)}": int(10 ** rng.uniform(0, 6)) for _ in range(700)} | {None: 12, "é": 0, "": 5, "\U0001f600": 9, "\uffee": 9}
    got, want = targets(spark, sizes), plain_targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def brute_mix(rows, weights=(1, 2, 3), most=3):
    """Sizes, sources and hashes as given: (h, source, size) in any order -> words taken of each."""
    by = Counter()
    for _, source, size in rows:
        by[source] += size
    goal = plain_targets(dict(by), weights, most)
    queue, upto = [], Counter()
    for h, source, size in sorted(rows, key=lambda r: r[0]):
        upto[source] += size
        if size and goal[source]:
            queue += [((r * by[source] + upto[source]) / goal[source], h, size) for r in range(most)]
    budget, used, taken = sum(by.values()), 0, Counter()
    for _, h, size in sorted(queue):
        if used + size > budget:
            break
        used += size
        taken[h] += size
    return goal, taken


def test_mix_matches_brute_force(spark, odd_rows):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(0, 80)), "en", rng.choice(["s1", "s1", "s1", "s2", "s10", None, "é"])) for i in range(400)]
    docs = docs_frame(spark, rows + [(None, None, "en", "s2"), (1000, "", "en", "only empty")])
    got = mixing.mix(docs)
    order = {}
    for r in docs.collect():
        ident = [] if r.doc_id is None else [str(r.doc_id)]
        order[r.doc_id] = hashlib.md5("\x1f".join(["mix", *ident, hashlib.md5((r.text or "").encode()).hexdigest()]).encode()).hexdigest()
    rows_ = {r.doc_id: r for r in got.collect()}
    goal, taken = brute_mix([(order[i], r.source, r.size) for i, r in rows_.items()])
    for i, r in rows_.items():
        assert r.target == pytest.approx(goal[r.source]) and r.taken == taken[order[i]], r
        assert r.taken <= 3 * r.size
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_mix_of_odd_rows(spark, odd_rows):
    got = mixing.mix(docs_frame(spark, odd_rows))
    assert got.count() == len(odd_rows)
    assert mixing.mix(docs_frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs_frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]
    out = mixing.mixed(docs_frame(spark, odd_rows).drop("size"))
    assert out.where("taken <= 0").count() == 0 and out.columns[-4:] == ["size", "source_size", "target", "taken"]


# --- URLs -----------------------------------------------------------------------------------------------------


def page(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_hosts_paths_and_rules(spark):
    urls = ["http://WWW.Example.com/en/1?x#y", "https://a.net/es/x", "https://net/es/", "https://anet/es/", "x://a.net?/es/", None, "no scheme", "http://h#f", "http://é.NET/fr/", "http://m.example.com/en/"]
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(page(spark, [(i, u, None) for i, u in enumerate(urls)])).orderBy("page_id").collect()]
    assert got == [
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("a.net", "/es/x", "net/es/", "block"), ("net", "/es/", "net/es/", "block"), ("anet", "/es/", None, "allow"),
        ("a.net", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow"), ("é.net", "/fr/", "net/fr/", "block"), ("m.example.com", "/en/", "example.com/en/", "block"),
    ]


def test_verdicts_reach_aliases(spark):
    link = '<link rel="canonical" href="{}">'.format
    pages = [
        (1, "http://plain.org/1", link("https://a.net/es/9")), (2, "http://plain.org/2#x", link("http://plain.org/1?utm_source=q")), (3, "http://plain.org/3", ""),
        (4, "http://both.org/1", link("https://a.net/fr/1")), (5, "http://both.org/2", '<META HTTP-EQUIV="refresh" CONTENT="0; URL=http://x.com/ok">'), (6, "http://both.org/2/", link("http://both.org/1")),
        (7, "https://b.net/es/1", link("http://x.com/ok")), (8, "http://plain.org/3?ref=z", None), (None, None, link("http://a.net/es/1")), (9, "http://self.org/1", link("http://self.org/1")),
    ]
    pages += [(100 + i, f"http://hot.org/{i}", link("http://a.net/fr/hot")) for i in range(300)] + [(1, "http://plain.org/1", link("https://a.net/es/9"))]
    got = [(r.page_id, r.verdict) for r in url_filter.judge(page(spark, pages).withColumn("node", F.lit(1)).withColumn("host", F.lit("x"))).collect()]
    verdict = dict(got)
    assert len(got) == len(pages)
    assert [verdict[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, None, 9)] == ["block", "block", "allow", "allow", "allow", "allow", "block", "allow", "allow", "allow"]
    assert {verdict[100 + i] for i in range(300)} == {"block"}


def test_relative_targets_and_long_tags(spark):
    link, far = '<link rel="canonical" href="{}">'.format, f'<link title="{"x" * 3000}" href="https://a.net/es/1" rel=canonical>'
    pages = [
        (1, "http://a.net/x/y?q", link("/es/1")), (2, "https://a.org/1", link("//a.net/es/1")), (3, "http://a.net/p", '<meta content="0;url=es/new" http-equiv=refresh>'), (4, "http://a.net/b/c/d", link("../../es/./2")),
        (5, "http://e.org/1", far), (6, "http://e.org/2", '<base href="https://a.net/es/"><meta http-equiv="refresh" content="0; url=3">'), (7, "http://e.org/3", link("mailto:a@a.net/es/1")), (8, "http://e.org/4?x", link("?x#y")),
        (9, "http://e.org/5", link("/go?to=https://a.net/es/1")), (10, "http://a.net", link("es/")), (11, "no scheme", link("/es/1")), (12, "http://e.org/6", "<link " * 50000),
    ]
    got = {r.page_id: r.verdict for r in url_filter.judge(page(spark, pages)).collect()}
    assert [got[i] for i in range(1, 13)] == ["block"] * 6 + ["allow"] * 3 + ["block"] + ["allow"] * 2


def test_redirect_table_and_no_pages(spark):
    moved = spark.createDataFrame([("http://q.org/1", "http://a.net/es/1"), (None, "x"), ("http://q.org/2", None)], "a string, b string")
    got = url_filter.judge(page(spark, [(1, "http://q.org/1", ""), (2, "http://q.org/2", "")]), redirects=moved)
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "allow"}
    assert url_filter.judge(page(spark, [])).count() == 0


# --- decontamination ------------------------------------------------------------------------------------------


def plain_words(text):
    return re.sub(r"[^\w\s]+|_", "", (text or "").lower()).split()


def brute_hits(docs, items, masks):
    """Alignments on which a mask fits exactly, scored word by word."""
    out = {}
    for doc, text in docs:
        w = plain_words(text)
        for item, itext in items:
            v = plain_words(itext)
            every = [*masks, *(["1" * len(v)] if 4 <= len(v) < min(map(len, masks)) else [])]
            for start in range(-len(v), len(w)):
                equal = [0 <= start + i < len(w) and w[start + i] == v[i] for i in range(len(v))]
                seeded = any(
                    all(equal[i + k] for k, c in enumerate(m) if c == "1") and start + i >= 0 and start + i + len(m) <= len(w)
                    for m in every
                    for i in range(len(v) - len(m) + 1)
                )
                if not seeded:
                    continue
                best = (0, 0, 0, 0)
                for a in range(len(v)):
                    score = hits = 0
                    for b in range(a, len(v)):
                        score += 1 if equal[b] else -3
                        hits += equal[b]
                        if (score, hits) > (best[0], best[3]):
                            best = (score, a, b + 1, hits)
                if best[3] >= min(12, len(v)):
                    out[doc, item, start] = (start + best[1], best[1], best[2] - best[1], best[3], len(v))
    return out


def test_overlaps_match_brute_force(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate([5, 8, 14, 20, 40, 60])] + [(6, None), (7, "too short"), (8, "!!")]
    docs = [(i, sentence(rng, rng.randrange(0, 70))) for i in range(40)]
    for i in range(60):
        w = items[i % 6][1].split()
        for _ in range(i % 7):
            w[rng.randrange(len(w))] = "odd"
        low = rng.randrange(0, max(1, len(w) // 3))
        docs.append((100 + i, f"{sentence(rng, rng.randrange(0, 9))} {' '.join(w[low:]).upper()}, {sentence(rng, 4)}"))
    docs += [(300, None), (301, ""), (302, items[4][1]), (302, items[4][1]), (303, items[3][1] + " " + items[3][1])]
    found = decontaminate.overlaps(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id, r.doc_start - r.item_start): (r.doc_start, r.item_start, r.n_words, r.n_equal, r.item_words) for r in found.collect()}
    want = brute_hits(docs, items, decontaminate.MASKS)
    same = lambda d: {k: (v[3], v[4]) for k, v in d.items()}
    assert same(got) == same(want) and len(want) > 30


@pytest.mark.parametrize("bound", [0, 500_000])
def test_clean_documents_stay(spark, bound):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("seed", F.lit(1)).withColumn("item_id", F.lit(2))
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = [" ".join((r.text or "").split()) for r in bench.collect()]
    dirty = {r.doc_id for r in docs.collect() if any(x in " ".join((r.text or "").split()) for x in items)}
    out = decontaminate.clean(docs, bench, broadcast_seeds=bound)
    assert out.columns == docs.columns
    assert {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in out.collect()} == dirty


@pytest.mark.parametrize("bound", [0, 500_000])
def test_items_without_an_id_or_with_a_repeated_one(spark, bound):
    rng = random.Random(18)
    a, b, c = (sentence(rng, n) for n in (20, 35, 5))
    items = [(None, a), (7, b), (7, c), (8, a), (None, "!!"), (None, None)]
    docs = [(1, f"x {a} y"), (2, f"q {b}"), (3, f"{c} z"), (4, "nothing of them"), (4, "nothing of them"), (5, f"{b} and {c}"), (None, a)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_frame(spark, docs)
    got = {(r.doc_id, r.item_id, r.doc_start, r.item_words) for r in decontaminate.overlaps(frame, bench, broadcast_seeds=bound).collect()}
    assert got == {(1, None, 1, 20), (1, 8, 1, 20), (2, 7, 1, 35), (3, 7, 0, 5), (5, 7, 0, 35), (5, 7, 36, 5), (None, None, 0, 20), (None, 8, 0, 20)}
    best = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.contaminated(frame, bench, broadcast_seeds=bound).collect()}
    assert best == {(1, None): 20, (1, 8): 20, (2, 7): 35, (3, 7): 5, (5, 7): 35, (None, None): 20, (None, 8): 20}
    assert [r.doc_id for r in decontaminate.clean(frame, bench, broadcast_seeds=bound).collect()] == [4, 4]
    assert decontaminate.overlaps(docs_frame(spark, [(1, "to be or")]), spark.createDataFrame([(1, "be or")], bench.schema), least_item=2).count() == 1


def test_seeds_find_what_a_full_comparison_finds(spark):
    """Recall against comparing every alignment: passages of 20 to 40 words with one word in eight replaced."""
    rng = random.Random(28)
    items = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 41)))) for i in range(60)]
    docs = []
    for i, text in items:
        w = [f"odd{i}" if rng.random() < 1 / 8 else x for x in text.split()]
        docs.append((i, f"{sentence(rng, 6)} {' '.join(w)} {sentence(rng, 6)}"))
    every = brute_hits(docs, items, ("1",))
    want = {(d, i) for d, i, _ in every}
    found = decontaminate.contaminated(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= want and len(got) >= 0.9 * len(want) > 40


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = docs_frame(spark, [(1, "a b c d e f g h i j k l m n")])
    assert decontaminate.clean(docs, none).count() == 1
    assert decontaminate.contaminated(docs_frame(spark, []), spark.createDataFrame([(1, "a b c d e f")], none.schema)).count() == 0


# --- archives -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_arc_comes_back(version):
    records = [arc_warc.ArcRecord("http://a/ b", "1.2.3.4", "20010203040506", "text/html", p) for p in (b"", b"\n\n", b"x\n1 2 3", bytes(range(256)))]
    got = list(arc_warc.read_arc(arc_warc.write_arc(records, version)))
    assert [r.payload for r in got] == [r.payload for r in records] and got[0].url == "http://a/%20b"
    assert arc_warc.iso_date("20010203040506") == "2001-02-03T04:05:06Z" and arc_warc.iso_date("1999") == "1999-01-01T00:00:00Z"


def test_broken_archives_are_refused():
    good = arc_warc.write_arc([arc_warc.ArcRecord("u", "i", "2001", "t", b"abc")], 1)
    for bad in (good[:-3], good.replace(b"u i 2001 t 3", b"u i 2001 t 9"), good.replace(b"u i 2001 t 3", b"u i 3"), good.replace(b"1 0 archive", b"7 0 archive")):
        with pytest.raises(ValueError, match="ARC"):
            list(arc_warc.read_arc(bad))
    with pytest.raises(ValueError, match="WARC"):
        list(arc_warc.read_warc(b"HTTP/1.0\r\n\r\n"))


def test_round_trip(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    rows += [(900, "http://a b\n", "x"), (901, None, "x"), (902, "u", None), (903, "u", ""), (904, "u", "\r\n\r\nWARC/1.0\r\n\r\n"), (905, "ü", "é\r\n\r\n"), (905, "ü", "é\r\n\r\n"), (10, "t", "x"), (None, "n", "x")]
    got = arc_warc.round_trip(page(spark, rows).withColumn("digest", F.lit(0)).withColumn("id", F.lit("z"))).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want, seen = [], set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        leads = i == first[html or ""] and payload not in seen
        seen.add(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((i, len(payload), digest, "response" if leads else "revisit", None if leads else first[html or ""]))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert len({r.record_id for r in got}) == len(rows)
    assert arc_warc.round_trip(page(spark, [])).count() == 0


def test_small_and_binary_payloads(spark, tmp_path):
    records = [arc_warc.ArcRecord(f"u{i}", "i", "2001", "image/png", p) for i, p in enumerate((b"\xff\xfe", b"\xff\xfe", b"a", b"a"))]
    archives = spark.createDataFrame([(["1", "2", "3", "4"], bytearray(arc_warc.write_arc(records)))], "ids array<string>, data binary")
    arc_warc.convert(archives, str(tmp_path / "w"), least_bytes=2)
    got = {r.number: (r.record_type, r.refers_to_number, bytes(r.payload)) for r in arc_warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {"1": ("response", None, b"\xff\xfe"), "2": ("revisit", "1", b""), "3": ("response", None, b"a"), "4": ("response", None, b"a")}


# --- pipeline -------------------------------------------------------------------------------------------------


def test_pipeline_matches_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.collect()
    model = language_id.fit(docs.where(~language_id.held_out()))
    names, scores = model.predict([r.text for r in rows])
    left = [r for r, n, s in zip(rows, names, scores, strict=True) if n != "und" and s >= language_id.LEAST_SCORE]
    component = {d: c for d, _, c in brute_components([(r.doc_id, r.text) for r in left])}
    left = [r for r in left if component[r.doc_id] == r.doc_id]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    joined = [" ".join(plain_words(t)) for _, t in items]
    left = [r for r in left if not any(x in " ".join(plain_words(r.text)) for x in joined)]
    masked = {r.doc_id: secret_scan._masked(r.text, secret_scan.spans_of(r.text), "[SECRET]") for r in left}
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", masked[r.doc_id])) for r in left}
    order = {i: hashlib.md5("\x1f".join(["mix", str(i), hashlib.md5(t.encode()).hexdigest()]).encode()).hexdigest() for i, t in masked.items()}
    _, taken = brute_mix([(order[r.doc_id], r.source, size[r.doc_id]) for r in left])
    got = {r.doc_id: (r.text, r.n_chars, r.size, r.taken) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == {i: (t, len(t), size[i], taken[order[i]]) for i, t in masked.items() if taken[order[i]]}


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "secret_scan", "mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() > 0.8 * docs.count()
        assert stage(spark, docs.limit(0), DATA).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), DATA).count() == 0


def test_stages_take_odd_rows(spark, odd_rows):
    docs = docs_frame(spark, odd_rows).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).collect()


# --- rules and links of url_filter, columns of mixed -----------------------------------------------------------


def test_a_thousand_rules_plan_and_match(spark):
    import random
    import time

    rng = random.Random(8)
    hosts = [f"h{i}.{d}" for i in range(120) for d in ("com", "net")] + ["com", "net", "a.b.com"]
    rules = [(rng.choice(["allow", "block"]), f"{rng.choice(hosts)}/{rng.choice(['', 'a', 'a/b', 'en/', 'fr/x'])}") for _ in range(1000)]
    urls = [f"http://{rng.choice(['', 'www.', 'x.y.', 'no'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/a/b/c', '/en/1', '/fr/x'])}" for _ in range(400)]
    start = time.perf_counter()
    rows = url_filter.judge(page(spark, [(i, u, None) for i, u in enumerate(urls)]), rules=rules).collect()
    took = time.perf_counter() - start

    def want(host, path):
        best = None
        for verdict, rule in rules:
            name, _, rest = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
                best = (verdict, rule)
        return best

    hit = 0
    for r in rows:
        best = want(r.host, r.path)
        assert r.rule == (best and best[1]) and (best is None or r.verdict == best[0])
        hit += best is not None
    assert hit > 100 and took < 60  # a plan that grows with the rules takes far longer


def test_no_rules(spark):
    got = url_filter.judge(page(spark, [(1, "http://a.net/es/", None)]), rules=()).first()
    assert got.rule is None and got.verdict == "allow"


@pytest.mark.parametrize("link", [
    '<link rel="canonical" href="http://b.net/es/p?x=1&amp;y=2">', '<link href="http:&#47;&#x2F;b.net/es/p?x=1&#38;y=2" rel="nofollow canonical">',
    "<LINK REL='canonical shortlink' HREF=http://b.net/es/p?x=1&amp;y=2>", "<link rel=canonical href='http://b.net/es/p?x=1&#x26;y=2'>",
])
def test_encoded_links_and_several_rel_words(spark, link):
    got = url_filter.judge(page(spark, [(1, "http://q.org/1", link), (2, "http://b.net/es/p?x=1&y=2", None), (3, "http://q.org/3", link.lower().replace("canonical", "canonicals"))]))
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "block", 3: "allow"}


def test_mixed_keeps_clashing_columns(spark):
    rows = [(i, f"word {i} more words", "s", 5, 2.0, "t") for i in range(6)] + [(0, "word 0 more words", "s", 4, 1.0, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, taken double, input_size string")
    got = mixing.mixed(docs)
    assert got.columns == ["doc_id", "text", "source", "input_input_size", "input_taken", "input_size", "size", "source_size", "target", "taken"]
    assert got.count() == 6 and {(r.input_input_size, r.input_taken) for r in got.where("doc_id = 0").collect()} == {(4, 1.0)}
