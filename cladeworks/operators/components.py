"""Connected components of an undirected graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import kept, remove
from .skew import FEW, hot_rows


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its least node.

    Each round links every node's larger neighbours to its least neighbour (large star), then its smaller
    neighbours to the least of them (small star). The edge count never grows, minima are pre-aggregated before
    the shuffle, and the number of rounds is logarithmic in the longest path. The edges of a node with very many of them
    never meet in one task: the minima of such nodes, fewer than skew.SHARE, are sent to where the edges are. Every round
    is written to the shared folder, so a lost executor costs one round at most. Null ends and loops are ignored.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("__x"), F.col(b).alias("__y"))
    stars = kept(edges.filter("__x is not null and __y is not null and a <> b").select("a", "b").distinct(), "edges")
    while total := _unfinished(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n"))
        large = _pulled(both.filter("b > a"), least, 2 * total).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = _pulled(large, lowest, total).filter("a <> b")
        done, stars = stars, kept(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "round")
        remove(done)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _unfinished(stars: DataFrame) -> int:
    """The number of edges (a, b), a > b, unless they are stars: each a below one b, which is below none."""
    ends = stars.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(stars.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("bad"), F.sum("up").alias("n")).first()
    return row["n"] if row["bad"] else 0


def _pulled(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """(a, b): of every edge (x, y), y and the least of x. least: a, m, n (edges of a); total: edges at most."""
    if total <= FEW:
        return edges.join(least.select("a", "m"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    is_hot = F.col("n") > hot_rows(total)
    hot = F.broadcast(least.filter(is_hot).select("a", "m"))
    near = edges.join(hot, "a")
    far = edges.join(hot, "a", "left_anti").join(least.filter(~is_hot).select("a", "m"), "a")
    return near.unionByName(far).select(F.col("b").alias("a"), F.col("m").alias("b"))
