"""What every filter does, alone and behind others, for every order in which filters can be applied.

Each document has a failure mask: one bit per filter that it fails. Spark counts the documents of every part (a source)
by mask, and with them those that carry a flag (good, toxic). A part is then at most 2**filters counts, however many
documents it has, and these make a decision diagram: one level per filter, each node with a child for "passes" and one
for "fails", the counts at the ends, equal nodes of a level kept once. An order of filters is an order of the levels.
Exchanging two adjacent levels only rebuilds those two, and plain changes visit all orders by such exchanges. In every
order the path of documents that pass everything gives the steps: at a level, the weight of the failing child goes, the
weight of the passing child stays.

Parts are spread over tasks; a source with a third of all rows is counted in every map task first and is then as small
as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import stored

#: From the text and its words to "fails"; None stands for "another row with a smaller id has the same text".
Filter = Callable[[Column, Column], Column] | None
Weight = tuple[int, ...]
MOST_FILTERS = 7  # 5,040 orders

FILTERS: dict[str, Filter] = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
    "C": lambda text, words: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
    "E": None,
}


class Diagram:
    """Weights of all failure masks as a decision diagram whose levels can be exchanged.

    `order` names the filter of each level. Level i holds its nodes by their (pass, fail) children; the last level holds
    the weights. A node keeps its number when levels are exchanged, so nothing above has to change.
    """

    def __init__(self, weights: Mapping[int, Weight], filters: int, width: int) -> None:
        self.order = list(range(filters))
        self.levels: list[dict] = [{} for _ in range(filters + 1)]
        self.children: dict[int, tuple[int, int]] = {}
        self.weight: dict[int, Weight] = {}
        self._next = 0
        nothing = (0,) * width

        def build(level: int, mask: int) -> int:
            if level == filters:
                return self._node(self.levels[level], weights.get(mask, nothing))
            return self._node(self.levels[level], (build(level + 1, mask), build(level + 1, mask | 1 << level)))

        self.root = build(0, 0)

    def _node(self, level: dict, what: tuple) -> int:
        """The node of a level with these children (or, at the ends, this weight), made if there is none."""
        if what in level:
            return level[what]
        node = level[what] = self._next
        self._next += 1
        if level is self.levels[-1]:
            self.weight[node] = what
        else:
            self.children[node] = what
            self.weight[node] = tuple(a + b for a, b in zip(self.weight[what[0]], self.weight[what[1]], strict=True))
        return node

    def exchange(self, i: int) -> None:
        """Exchange levels i and i + 1; every node of level i goes on to stand for the same masks."""
        upper, lower = {}, {}
        for (low, high), node in self.levels[i].items():
            (both, second), (first, neither) = self.children[low], self.children[high]
            pair = (self._node(lower, (both, first)), self._node(lower, (second, neither)))
            self.children[node] = pair
            upper[pair] = node
        for node in self.levels[i + 1].values():
            del self.children[node], self.weight[node]
        self.levels[i], self.levels[i + 1] = upper, lower
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(filter, what it leaves, what it removes) along the path that passes everything."""
        node = self.root
        for name in self.order:
            node, gone = self.children[node]
            yield name, self.weight[node], self.weight[gone]


def plain_changes(n: int) -> Iterator[int]:
    """Places i such that exchanging i and i + 1, one after the other, visits every order of n things once."""
    if n < 2:
        return
    down = True
    for inner in [*plain_changes(n - 1), None]:  # the last thing sweeps through, then the others change once
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + down
        down = not down


def part_report(weights: Mapping[int, Weight], names: str, width: int) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, flags lost ..., shapley) for every order and step."""
    n = len(names)
    diagram = Diagram(weights, n, width)
    orders = [(tuple(diagram.order), list(diagram.steps()))]
    for place in plain_changes(n):
        diagram.exchange(place)
        orders.append((tuple(diagram.order), list(diagram.steps())))
    fails, alone, shapley = [0] * n, [0] * n, [0] * n
    for _, steps in orders:
        (first, _, most), (last, _, least) = steps[0], steps[-1]
        fails[first], alone[last] = most[0], least[0]
        for name, _, gone in steps:
            shapley[name] += gone[0]
    out = []
    for order, steps in orders:
        spelled = "".join(names[i] for i in order)
        for step, (i, kept, gone) in enumerate(steps, 1):
            out.append((spelled, step, kept[0], gone[0], fails[i] - gone[0], alone[i], *gone[1:], shapley[i]))
    return out


def failures(
    docs: DataFrame, flagged: DataFrame, flags: Mapping[str, Column], filters: Mapping[str, Filter], id_col: str, text_col: str, part_col: str
) -> DataFrame:
    """(part, mask, n and one count per flag): the documents of every part by failure mask."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"), text.alias("t"),
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    mask = F.lit(0)
    for bit, fails in enumerate(filters.values()):
        if fails is not None:
            mask = mask + F.when(fails(F.col("t"), F.col("words")), 1 << bit).otherwise(0)
    rows = rows.select("id", "part", mask.alias("mask"), F.sha2(F.col("t").cast("binary"), 256).alias("print"))
    # several labels of one id: a flag holds when any of them says so
    marks = flagged.groupBy(F.col(f"`{id_col}`").alias("id")).agg(*[F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in flags.items()])
    rows = stored(rows.join(marks, "id", "left").select("print", "id", "part", "mask", *[F.coalesce(n, F.lit(0)).alias(n) for n in flags]))
    counts = [F.count("*").alias("n"), *[F.sum(n).alias(n) for n in flags]]
    copy_bits = [bit for bit, fails in enumerate(filters.values()) if fails is None]
    if not copy_bits:
        return rows.groupBy("part", "mask").agg(*counts)
    # Copies are all rows less those without a smaller id. The smallest id of a text is found with counts made in the
    # map tasks, and joined by text and id, so a text that a third of all rows share is no hot key.
    ids = rows.where("id is not null")
    smallest = ids.groupBy("print").agg(F.min("id").alias("id"))
    first = ids.join(smallest, ["print", "id"], "left_semi").unionByName(rows.where("id is null"))
    firsts = first.groupBy("part", "mask").agg(*counts)
    minus = firsts.select("part", (F.col("mask") + (1 << copy_bits[0])).alias("mask"), *[(-F.col(c)).alias(c) for c in ("n", *flags)])
    every = rows.groupBy("part", (F.col("mask") + (1 << copy_bits[0])).alias("mask")).agg(*counts)
    both = firsts.unionByName(minus).unionByName(every)
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", *flags)])


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Filter] = FILTERS,
    flags: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of filters and step.

    Columns: part, filter_order, step (from 1), kept, removed, redundant (fail this filter, removed before), unique_fails
    (fail this filter only), `<flag>_lost` (removed here with the flag), shapley (removed by the filter, summed over all
    orders). `filters` maps one-letter names to conditions; at most one of them is None, the filter of copies. `flags`
    maps names to conditions on the columns of `labels`.

    A null text is empty, a null part is the empty string and joins it. Rows with equal id and text are no copies of each
    other; a row without id is never a copy and never makes one. Labels of unknown ids are left out, several labels of
    one id count as any of them. An empty table has no parts and gives no rows. Very long texts are read whole, as an
    array of their words in one task. Columns not named are not read, whatever their names.
    """
    flags = flags if flags is not None else {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    if len(filters) > MOST_FILTERS or any(len(n) != 1 for n in filters) or list(filters.values()).count(None) > 1:
        raise ValueError(f"at most {MOST_FILTERS} filters with names of one letter, one of them for copies")
    counted = failures(docs, labels, flags, filters, id_col, text_col, part_col)
    width = 1 + len(flags)
    entry = F.struct("mask", F.array("n", *flags).alias("weight"))
    parts = counted.where("n > 0").groupBy("part").agg(F.collect_list(entry).alias("masks"))  # at most 2**filters entries
    names = "".join(filters)
    columns = ["kept", "removed", "redundant", "unique_fails", *[f"{n}_lost" for n in flags], "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                weights = {m["mask"]: tuple(m["weight"]) for m in row["masks"]}
                values = list(zip(*part_report(weights, names, width), strict=True))
                arrays = [pa.array([row["part"]] * len(values[0]), pa.string()), pa.array(values[0], pa.string()), pa.array(values[1], pa.int32())]
                arrays += [pa.array(v, pa.int64()) for v in values[2:]]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *columns])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns)
    return parts.mapInArrow(run, schema)
