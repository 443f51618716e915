"""Secret scanning that reads assignments.

Four kinds of spans, as code points with an exclusive end:

* `assign`, `access`, `hex`: fixed patterns, leftmost and non-overlapping for each kind.
* `flow`: literals that the lexer ties to a sensitive name. Text is read as source or configuration lines into
  (name, expression) pairs: `name = expr`, `name: expr`, `name := expr`, `"name": expr`, `name => expr`, after
  `export`, `set`, `let`, `const`, `var`, `final`, `def` and the like. An expression is a sequence of literals and
  names joined by `+`, `.` or nothing (then what follows is a quoted literal, or a `$name` without a blank before it,
  and no name of the next pair). Constants are propagated: a name stands for the literals it was last given, so
  in `a = "Zx81..."` / `password = a` the literal of the first line belongs to `password`. Every literal is scored by
  the most sensitive name that it reaches and by its own form; words such as `example`, `changeme` and `${...}` are
  no secrets.

Each text is read by itself, so rows need no shuffle and a lost executor costs its tasks only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "flow")
MIN_SCORE = 1.0
# The patterns and the least lengths of the base kinds.
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_NEEDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# Parts of a name and how sensitive they make it.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.7, "secret": 1.0, "token": 0.9,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "bearer": 0.8, "signature": 0.5, "salt": 0.5, "auth": 0.6,
    "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5, "signing": 0.5, "encryption": 0.5, "client": 0.2, "session": 0.3,
}
#: Parts that say the value is about a secret, not one.
NAME_DENIALS = {"public", "length", "len", "count", "name", "path", "file", "url", "uri", "type", "label", "id", "hint", "field", "expires", "expiry", "ttl", "limit", "size"}
PLACEHOLDERS = re.compile(r"(?i)example|sample|change.?me|placeholder|your.?(password|secret|token|key)|redacted|dummy|xxxx|\*\*\*|^<.*>$|^\$|^%|^\{\{|^(none|null|true|false|undefined|todo|test|password|secret|token)$")

_LEAD = r"(?:(?:export|set|setenv|let|const|var|val|final|static|public|private|protected|def|my|local|readonly|string|str|char)\s+){0,4}"
_NAME = r"[A-Za-z_$@][A-Za-z0-9_$]*(?:[.\-][A-Za-z_][A-Za-z0-9_]*)*"
#: A pair on one line; what follows the operator is read by _TERM. Names and subscripts have any length: what they
#: scan ends at the next quote or bracket, so no character is read twice for the same kind of opening.
_PAIR = re.compile(rf"""(?:^|(?<=[\s;,{{(\[&?]))(?i:{_LEAD})(?:"(?P<q>[^"\n]++)"|'(?P<s>[^'\n]++)'|(?P<n>{_NAME}))(?:\[["'](?P<k>[^"'\]\n]++)["']\]|\[[^\[\]\n]*+\])?[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*""", re.M)
_TERM = re.compile(rf"""(?:[bru]{{0,2}})"(?P<d>(?:[^"\\\n]|\\.)*)"|(?:[bru]{{0,2}})'(?P<s>(?:[^'\\\n]|\\.)*)'|`(?P<b>[^`\n]*)`|(?P<n>{_NAME})(?![\w(])|(?P<v>[^\s;,"'`)\]}}]+)""")
_JOIN = re.compile(r"[ \t]*(?:\+|\.(?=[\s\"'A-Za-z_$])|&|\|\|)?[ \t]*")
#: What may follow with nothing between.
_ADJACENT = re.compile(r"""[ \t]*+(?=[bru]{0,2}["']|`)|(?=\$[A-Za-z_])""")
_NAMES_A_PAIR = re.compile(r"[ \t]*(?::=|=>|=(?!=)|:(?![:/]))")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LEAST_LITERAL = 6


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns. A match that is too short is dropped and its text passed over."""
    out = []
    low = text.lower()
    if any(x in low for x in _ASSIGN_NEEDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """How strongly a name says that its value is secret, from 0 to 1."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[-1] in NAME_DENIALS or "public" in parts:
        return 0.0
    return min(1.0, sum(NAME_WEIGHTS.get(p, 0.0) for p in set(parts)))


def literal_score(value: str) -> float:
    """How much a literal looks like a secret rather than a word, from 0 to 1."""
    if len(value) < LEAST_LITERAL or PLACEHOLDERS.search(value) or len(set(value)) < 4:
        return 0.0
    counts = [value.count(c) for c in set(value)]
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in value)
    if " " in value.strip() and kinds < 3:
        return 0.0
    return min(1.0, 0.15 * bits + 0.15 * (kinds - 1) + (0.1 if len(value) >= 16 else 0.0))


def _terms(text: str, at: int) -> tuple[list[tuple[str, int, int, str]], int]:
    """Literals and names of the expression at `at`: (kind, start, end, value), and where it ends."""
    out = []
    while m := _TERM.match(text, at):
        group = m.lastgroup
        kind = {"n": "name", "v": "bare"}.get(group, "literal")
        out.append((kind, m.start(group), m.end(group), m[group]))
        at = m.end()
        join = _JOIN.match(text, at)
        if not join[0].strip():
            join = _ADJACENT.match(text, at)
            term = join and _TERM.match(text, join.end())
            if not term or term.lastgroup == "v" or _NAMES_A_PAIR.match(text, term.end()):
                break
        at = join.end()
    return out, at


def pairs(text: str) -> list[tuple[str, list[tuple[str, int, int, str]]]]:
    """(name, terms) of every assignment, in text order."""
    out, at = [], 0
    while m := _PAIR.search(text, at):
        terms, _ = _terms(text, m.end())
        if terms:
            out.append((m["k"] or m["q"] or m["s"] or m["n"] or "", terms))
        at = max(m.end(), m.start() + 1)
    return out


def flow_spans(text: str, least: float = MIN_SCORE) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly or through other names."""
    low = text.lower()
    if not any(c in text for c in "=:") or not any(x in low for x in NAME_WEIGHTS):  # no pair, or no name that counts
        return []
    # one node per assignment: its own literals, and the nodes of the names it uses, as they stood then
    own: list[list[tuple[int, int, str]]] = []
    uses: list[list[int]] = []
    given: dict[str, int] = {}
    targets: list[tuple[float, int]] = []
    for name, terms in pairs(text):
        literals, used = [], []
        for kind, start, end, value in terms:
            if kind == "name" and value in given:
                used.append(given[value])
            elif kind != "name" or len(terms) == 1 and not value.isalpha():  # KEY=abc123 is a literal without quotes
                literals.append((start, end, value))
        own.append(literals)
        uses.append(used)
        given[name] = len(own) - 1
        if sensitive := name_score(name):
            targets.append((sensitive, len(own) - 1))
    out: list[tuple[int, int, str]] = []
    visited: set[int] = set()
    for sensitive, target in sorted(targets, key=lambda x: (-x[0], x[1])):  # the first visit has the best name
        stack = [target]
        while stack:
            node = stack.pop()
            if node not in visited:
                visited.add(node)
                stack += uses[node]
                out += [(s, e, "flow") for s, e, value in own[node] if (form := literal_score(value)) and sensitive + form >= least]
    return sorted(out)


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed."""
    if not text:
        return []
    return sorted(base_spans(text) + flow_spans(text), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `found`, an array of (kind, start, end), for every row.

    Null and empty texts have none. Repeated rows get equal answers; an empty table gives no rows; other columns are
    not read.
    """
    return _with_spans(docs, text_col, keep, None).withColumnRenamed(FOUND, "found")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of `docs`, with every found span replaced by `mark` (overlapping spans by one)."""
    return _with_spans(docs, text_col, tuple(docs.columns), mark).drop(FOUND)


FOUND = "__found"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _with_spans(docs: DataFrame, text_col: str, keep: tuple[str, ...], mark: str | None) -> DataFrame:
    """`keep` columns with the spans; with a mark, the text among them is masked."""
    inner = [f"c{i}" for i in range(len(keep))]
    at = keep.index(text_col) if text_col in keep else len(keep)
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner, strict=True)]
    taken = docs.select(*columns, *([F.col(f"`{text_col}`").alias("text")] if at == len(keep) else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [spans_of(t) for t in texts]
            out = list(batch.columns[: len(inner)])
            if mark is not None:
                out[at] = pa.array([_masked(t, f, mark) if f else t for t, f in zip(texts, found, strict=True)], pa.string())
            listed = pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in f] for f in found], _SPANS)
            yield pa.RecordBatch.from_arrays([*out, listed], names=[*inner, FOUND])

    schema = ", ".join(f"{n} {taken.schema[n].dataType.simpleString()}" for n in inner)
    out = taken.mapInArrow(run, f"{schema}, {FOUND} array<struct<kind:string,start:int,end:int>>")
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, keep, strict=True)], FOUND)


def _masked(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    out, at = [], 0
    last = -1
    for start, end, _ in spans:
        if start >= last:
            out += [text[at:start], mark]
        last = at = max(last, end)
    return "".join([*out, text[at:]])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of `scan`."""

    def joined(spans):  # noqa: ANN001, ANN202
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["kind"] != "flow")
    counts = [F.size(F.filter("found", lambda x: x["kind"] == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
