"""Connected components of edge tables too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import stored

MAX_ROUNDS = 50


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges, root being the smallest node that it is connected with.

    Alternates the large-star and small-star steps of Kiveris et al.: nodes are hung on the smallest neighbour until
    every component is one star. Each step is an aggregate with map-side combine and a join on the node, so a node
    with very many neighbours is pre-aggregated and its join partition can be split. Null ends are ignored, loops and
    repeated edges do no harm, no edges give no rows. Every round is stored, which cuts lineage.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    now = edges.where(x.isNotNull() & y.isNotNull() & (x != y))
    now = stored(now.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        now = stored(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return int(row.n), row.s


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour (or on itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.where("v > u").join(least, "u").where("v != m")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
