"""Intervals inherited through a tree, and masking them in an alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import kept, remove


def tip_closure(edges: DataFrame) -> DataFrame:
    """(node, tip): the tips at or below every node of the trees (parent, child); a tip is below itself.

    Pointers from each tip jump twice as far up each round, so a tree of depth d takes about log2(d) rounds. What is kept
    are pairs of tips and nodes above them, which is the result itself, and one jump table a round, a row for each node.
    """
    up = edges.filter("parent is not null").select(F.col("child").alias("node"), F.col("parent").alias("above")).distinct()
    tips = edges.select(F.col("child").alias("tip")).join(edges.select(F.col("parent").alias("tip")), "tip", "left_anti").distinct()
    # reach: every node of the first 2**k steps above a tip, tip included; jump: the node 2**k steps above
    reach, jump = kept(tips.select("tip", F.col("tip").alias("node")), "closure"), kept(up, "jump")
    while not jump.isEmpty():
        more = reach.join(jump, "node").select("tip", F.col("above").alias("node"))
        grown = kept(reach.unionByName(more), "closure")
        far = kept(jump.join(jump.select(F.col("node").alias("above"), F.col("above").alias("far")), "above").select("node", F.col("far").alias("above")), "jump")
        for done in (reach, jump):
            remove(done)
        reach, jump = grown, far
    return reach.select("node", "tip").distinct()


def unknown_nodes(intervals: DataFrame, closure: DataFrame) -> DataFrame:
    """Interval nodes that the tree lacks; a caller treats any row as an error."""
    return intervals.select("node").distinct().join(closure.select("node").distinct(), "node", "left_anti")


def require_known_nodes(intervals: DataFrame, closure: DataFrame) -> DataFrame:
    """intervals, or an error that names nodes that the tree lacks."""
    if found := unknown_nodes(intervals, closure).limit(5).collect():
        raise ValueError("intervals of nodes that are not in the tree: " + ", ".join(str(r["node"]) for r in found))
    return intervals


def tip_intervals(intervals: DataFrame, closure: DataFrame) -> DataFrame:
    """(tip, start, stop): 0-based half-open intervals of all nodes above each tip, disjoint and in order."""
    rows = intervals.join(closure, "node").select("tip", "start", "stop").filter("stop > start").distinct()
    order = Window.partitionBy("tip").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("island", F.sum(F.when(F.col("start") > reach, 1).otherwise(0)).over(order))
    return rows.groupBy("tip", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).select("tip", "start", "stop")


def mask(alignment: DataFrame, intervals: DataFrame) -> DataFrame:
    """(seq_id, seq) with N at every position inside the tip's intervals; others and positions beyond stay.

    Intervals are disjoint, so a sequence is rebuilt once from the pieces between them, whatever their length.
    """
    spans = intervals.groupBy(F.col("tip").alias("seq_id")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = alignment.select("seq_id", "seq").join(spans, "seq_id", "left")
    n = F.length("seq")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        stop = F.least(s["stop"].cast("int"), n)
        start = F.least(F.greatest(s["start"].cast("int"), acc["at"]), n)
        kept_part = F.substring(F.col("seq"), acc["at"] + 1, start - acc["at"])
        return F.struct(F.concat(acc["out"], kept_part, F.repeat(F.lit("N"), F.greatest(stop - start, F.lit(0)))).alias("out"), F.greatest(stop, start).alias("at"))

    masked = F.aggregate("spans", zero, step, lambda a: F.concat(a["out"], F.substring(F.col("seq"), a["at"] + 1, n)))
    return rows.select("seq_id", F.coalesce(masked, F.col("seq")).alias("seq"))
