"""Connected components by alternating large-star and small-star.

Every round is two joins and aggregations: each node's smallest neighbour comes from a
map-side combined minimum, then every edge is led to it. No neighbourhood is ever gathered in
one task: the minima of hubs, nodes with over a thousandth of all edges, are broadcast and their
edges stay where they are. Rounds end when the edges no longer change; their number grows with
the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, join_unique, stored


def _lead(edges: DataFrame, large: bool, n_edges: int) -> DataFrame:
    """One star operation over distinct edges (a, b) with a > b.

    Large star: larger neighbours of u are led to the smallest node of u's neighbourhood.
    Small star: u and its smaller neighbours are led to the smallest of them.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    led = join_unique(both, least, ["u"], "n", 2 * n_edges)
    if large:
        out = led.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = led.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Self loops and null ends are left out. An edge list without edges gives an empty result.
    """
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = stored(now.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    mark = print_of(now)
    for _ in range(max_rounds):
        led = stored(_lead(now, True, mark[0]), "edges")
        new = stored(_lead(led, False, mark[0]), "edges")
        drop(now, led)
        now, last, mark = new, mark, print_of(new)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled edges form stars: each node but the smallest has one edge, to the smallest.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
