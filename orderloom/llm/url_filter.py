"""URL filtering with redirect equivalence.

A URL is judged by host and path rules first; the longest rule that fits decides. URLs that lead to the same resource
are aliases: pages point to their canonical link or to a refresh target, a redirect table may add more, and URLs that
differ only in scheme, fragment, tracking parameters or a trailing slash are sent to one form by every server. Over
these edges connected components are found in Spark, and a decision reaches all aliases: a component with an explicit
allow is allowed, else one with a block is blocked. A URL with a rule of its own keeps that rule's verdict.

Built-in expressions only. A rule table is small and its size is checked; pages are never compared with each other,
and a target that very many pages name is one star, pre-aggregated before each shuffle.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.session import stored

ALLOW, BLOCK = "allow", "block"
#: (verdict, host and path), as given.
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
MOST_RULES = 10_000
TRACKING = r"(?i)^(utm_[a-z]+|gclid|fbclid|ref|mc_[a-z]+)="
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty when there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *_LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty when there is no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def one_form(url: Column) -> Column:
    """The form that aliases of a URL share: no scheme, fragment, tracking parameters or trailing slash. Null without ://."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(url.contains("://"), F.concat(host_of(url), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; the first of rules of equal length.

    A rule (host, path) fits its host and all subdomains when the path starts with its own. The rules are one literal, a
    hash table by host: each suffix of a host asks one bucket, so neither plan nor rows grow with the number of rules.
    """
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    if not rules:
        return none
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules do not fit into the plan")
    buckets: list[list[dict]] = [[] for _ in range(len(rules))]
    for n, (verdict, rule) in enumerate(sorted(rules, key=lambda r: -len(r[1]))):  # stable, so the first of equals comes first
        name, _, rest = rule.partition("/")
        buckets[zlib.crc32(name.encode()) % len(buckets)].append({"n": n, "host": name, "path": f"/{rest}", "rule": rule, "verdict": verdict})
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<n:int,host:string,path:string,rule:string,verdict:string>>>")
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    def fitting(suffix: Column) -> Column:
        bucket = F.get(table, F.pmod(F.crc32(suffix.cast("binary")), F.lit(len(buckets))).cast("int"))
        return F.filter(bucket, lambda r: (r["host"] == suffix) & F.startswith(path, r["path"]))

    best = F.array_min(F.flatten(F.transform(suffixes, fitting)))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict"))).otherwise(none)


def _attribute(name: str, value: str) -> str:
    """Pattern of an attribute in a tag."""
    return rf"""(?is)(?<![\w-]){name}\s*+=\s*+["']?{value}"""


#: One of the words of a rel attribute, quoted or not.
_CANONICAL = r"""(?:(?<=")(?:[^">]*\s)?|(?<=')(?:[^'>]*\s)?|(?<![\w"'-]))canonical(?=["'\s>]|$)"""


def named_targets(html: Column) -> Column:
    """What a page names as its own place, as written: canonical links and refresh targets.

    Tags are cut out whole and their attributes read in any order; an unclosed tag goes to the end of the page. `rel` may
    have several words. Targets are decoded: `&amp;` and the numeric forms of the characters that URLs are made of.
    """
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*+"), F.lit(0)), lambda t: t.rlike(_attribute("rel", _CANONICAL)))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*+"), F.lit(0)), lambda t: t.rlike(_attribute("http-equiv", r"refresh\b")))
    link = F.transform(links, lambda t: F.regexp_extract(t, _attribute("href", r"""([^"'\s>]+)"""), 1))
    fresh = F.transform(metas, lambda t: F.regexp_extract(t, _attribute("content", r"""\s*+[0-9.]*+\s*+;\s*+url\s*+=\s*+['"]?([^"'\s>]+)"""), 1))
    return F.filter(F.transform(F.array_union(link, fresh), _decoded), lambda u: u != "")


def _decoded(text: Column) -> Column:
    """Character references of URL characters as characters; `&` comes last, so what it uncovers is not read again."""
    for c in "/:?=#.-_%+,;@~&":
        names = "|amp" if c == "&" else ""
        text = F.regexp_replace(text, rf"(?i)&(?:#0*+{ord(c)}|#x0*+{ord(c):x}{names});", c)
    return text


def _base_targets(html: Column) -> Column:
    """What the first <base href> of a page names, as an array of at most one."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<base\b[^>]*+"), F.lit(0))
    hrefs = F.transform(tags, lambda t: F.regexp_extract(t, _attribute("href", r"""([^"'\s>]+)"""), 1))
    return F.slice(F.filter(F.transform(hrefs, _decoded), lambda u: u != ""), 1, 1)


def resolved(targets: Column, base: Column) -> Column:
    """Targets as full URLs, those without a scheme relative to `base` (RFC 3986); other schemes are left out.

    Without a full base, only full targets are given. `base` should be a column, as it is read many times.
    """

    def join(target):  # noqa: ANN001, ANN202
        origin, path = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0), path_of(base)
        return (
            F.when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), target))
            .when(F.startswith(target, F.lit("/")), F.concat(origin, target))
            .when(F.startswith(target, F.lit("?")), F.concat(origin, path, target))
            .when(F.startswith(target, F.lit("#")), F.concat(F.regexp_extract(base, r"(?s)^[^#]*", 0), target))
            .otherwise(F.concat(origin, F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^.*/", 0)), target))
        )

    full = F.filter(targets, lambda u: u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+://"))
    relative = F.filter(targets, lambda u: ~u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+:") & F.coalesce(base.contains("://"), F.lit(False)))
    return F.concat(full, F.transform(F.transform(relative, join), _without_dots))


def _without_dots(url: Column) -> Column:
    """A full URL with the segments . and .. of its path carried out."""
    origin, path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0), path_of(url)
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    none = F.array().cast("array<string>")

    def step(kept, x):  # noqa: ANN001, ANN202
        return F.when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))

    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), none, step)
    kept = F.concat(F.array(F.lit("")), kept, F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(none))
    rest = F.substring(url, F.length(origin) + F.length(path) + 1, F.length(url))
    return F.when(path.rlike(r"/\.{1,2}(?:/|$)"), F.concat(origin, F.array_join(kept, "/"), rest)).otherwise(url)


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
    rules: Sequence[tuple[str, str]] = RULES,
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, alias_root (hash naming its component, null without edges).

    `redirects` may add (source, target) URLs. A null URL, or one without ://, has an empty host and path, no rule and
    no aliases, and is allowed. Relative targets
    are resolved against the page. Repeated URLs are one node and get one answer. An empty table gives no rows; other
    columns are not read. Nodes are 64-bit hashes of URL forms.
    """
    url = F.col(f"`{url_col}`")
    none = F.array().cast("array<string>")
    html = F.col(f"`{html_col}`") if html_col else F.lit(None).cast("string")
    seen = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), F.coalesce(named_targets(html), none).alias("named"), F.coalesce(_base_targets(html), none).alias("based"))
    seen = seen.withColumn("based", F.coalesce(F.get(resolved(F.col("based"), F.col("url")), F.lit(0)), "url"))
    url = F.col("url")
    seen = seen.select("id", host_of(url).alias("host"), path_of(url).alias("path"), one_form(url).alias("form"), resolved(F.col("named"), F.col("based")).alias("targets"))
    seen = seen.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    seen = stored(seen.withColumn("node", F.xxhash64("form")).withColumn("node", F.when(F.col("form").isNotNull(), F.col("node"))))
    pointed = seen.where(F.size("targets") > 0).select("node", F.explode("targets").alias("target"))
    more = pointed.select("node", "target")
    if redirects is not None:
        source, target = (F.col(f"`{c}`") for c in redirects.columns[:2])
        moved = redirects.where(source.isNotNull() & target.isNotNull())
        more = more.union(moved.select(F.xxhash64(one_form(source)), target)).union(moved.select(F.xxhash64(one_form(target)), source))
    # a target has a verdict of its own even where it is no page of the table
    more = more.where(one_form(F.col("target")).isNotNull())
    ends = more.select("node", F.xxhash64(one_form(F.col("target"))).alias("other"), matching_rule(host_of(F.col("target")), path_of(F.col("target")), rules).alias("hit"))
    ends = stored(ends)
    edges = ends.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    roots = stored(components(edges))
    said = seen.where("hit is not null and node is not null").select("node", "hit.verdict")
    said = said.union(ends.where("hit is not null").select("other", "hit.verdict"))
    said = said.groupBy("node").agg(F.max(F.col("verdict") == ALLOW).alias("allowed"), F.max(F.col("verdict") == BLOCK).alias("blocked"))
    placed = said.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = placed.groupBy("root").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    # only rows without a rule ask their aliases, once per node; most nodes have no edge and answer for themselves
    asking = seen.where("hit is null and node is not null").select("node").distinct()
    answers = asking.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(by_root, "root")
    answers = answers.select("node", F.when(F.col("allowed"), ALLOW).when(F.col("blocked"), BLOCK).alias("shared"))
    names = roots.select("node", F.col("root").alias("alias_root"))
    out = seen.join(answers, "node", "left").join(names, "node", "left")
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", "shared", F.lit(ALLOW)).alias("verdict"), "alias_root",
    )
