"""Clusters of samples: splitting, routing, merging, medoids and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import kept
from .components import connected_components

MERGED = "merged_small_clusters"


def single_linkage(nodes: DataFrame, edges: DataFrame, sample: str = "sample_id") -> DataFrame:
    """(sample, component) of every node; isolated nodes are components of their own."""
    found = connected_components(edges).withColumnRenamed("node", sample)
    return nodes.select(sample).distinct().join(found, sample, "left").select(sample, F.coalesce("component", sample).alias("component"))


def split_oversize(members: DataFrame, most: int, sample: str = "sample_id", component: str = "component") -> DataFrame:
    """(cluster_id, sample): components in chunks of at most `most` in order of sample, numbered by least sample.

    A sample's place in its component is its place in a range of the sorted members, plus the component's members in the
    ranges before: no task needs a whole component. Numbers come from one row for each chunk.
    """
    ranged = members.select(component, sample).repartitionByRange(component, sample).sortWithinPartitions(component, sample)
    # the range is the high half of this number, the place in it the low half; both are fixed by writing them
    ranged = kept(ranged.withColumn("__at", F.monotonically_increasing_id()), "members").withColumn("__range", F.shiftright("__at", 33))
    parts = ranged.groupBy(component, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(component).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("__before", F.coalesce(before, F.lit(0))).select(component, "__range", "__first", "__before")
    place = F.col("__before") + F.col("__at") - F.col("__first")
    chunk = ranged.join(parts, [component, "__range"]).select(component, sample, F.floor(place / most).cast("int").alias("chunk"))
    return numbered(chunk, [component, "chunk"]).select("cluster_id", sample)


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows plus cluster_id: cluster_0, cluster_1, ... in order of the keys.

    Ranks over all groups without one task for all: groups are ranked inside ranges of the keys, which are written, and a
    row for each range says how many come before it.
    """
    groups = rows.groupBy(*keys).agg(F.count("*").alias("__n")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # a place inside the range is the low half of this number, the range the high half; both are fixed by writing them
    inside = kept(groups.select(*keys, F.monotonically_increasing_id().alias("__at")), "ranges")
    inside = inside.withColumn("__range", F.shiftright("__at", 33)).withColumn("__i", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = inside.groupBy("__range").agg(F.count("*").alias("__size"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ids = inside.join(F.broadcast(before.select("__range", "__before")), "__range")
    ids = ids.select(*keys, F.concat(F.lit("cluster_"), (F.col("__before") + F.col("__i")).cast("string")).alias("cluster_id"))
    return rows.join(ids, keys)


def sizes(members: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return members.groupBy(cluster).agg(F.count("*").alias("n_isolates"))


def size_classes(cluster_sizes: DataFrame) -> DataFrame:
    """One row: number, mean, extremes and size classes of clusters."""
    n = F.col("n_isolates")
    return cluster_sizes.agg(
        F.count("*").alias("n_clusters"), F.sum(n).alias("n_samples"), F.round(F.avg(n), 6).alias("mean_size"), F.max(n).alias("max_size"), F.min(n).alias("min_size"),
        F.count_if(n == 1).alias("size_1"), F.count_if(n.between(2, 5)).alias("size_2_5"), F.count_if(n.between(6, 20)).alias("size_6_20"), F.count_if(n > 20).alias("size_over_20"),
    )


def route(cluster_sizes: DataFrame) -> DataFrame:
    """Adds route: viable (3 or more), small (2) or singleton."""
    n = F.col("n_isolates")
    return cluster_sizes.withColumn("route", F.when(n >= 3, "viable").when(n == 2, "small").otherwise("singleton"))


def merge_small(members: DataFrame, merge: bool = True) -> DataFrame:
    """Viable clusters, and one cluster of all samples of smaller ones if these are three or more; else they go."""
    routed = members.join(route(sizes(members)), "cluster_id")
    viable = routed.filter("route = 'viable'").select("sample_id", "cluster_id")
    if not merge:
        return viable
    small = routed.filter("route <> 'viable'").select("sample_id", F.lit(MERGED).alias("cluster_id"))
    enough = small.agg(F.count("*").alias("n")).filter("n >= 3").select(F.lit(MERGED).alias("cluster_id"))
    return viable.unionByName(small.join(F.broadcast(enough), "cluster_id", "left_semi").select("sample_id", "cluster_id"))


def summary_lines(cluster_sizes: DataFrame) -> DataFrame:
    """(line): a text summary, a line for all and one for each cluster."""
    one = size_classes(cluster_sizes)
    top = one.select(F.lit(0).alias("k"), F.lit("").alias("c"), F.format_string("%d clusters of %d samples, largest %d", "n_clusters", "n_samples", "max_size").alias("line"))
    rows = cluster_sizes.select(F.lit(1).alias("k"), F.col("cluster_id").alias("c"), F.format_string("%s: %d", "cluster_id", "n_isolates").alias("line"))
    return top.unionByName(rows).orderBy("k", "c").select("line")


def medoids(classes: DataFrame, pairs: DataFrame, missing: float = 1.0) -> DataFrame:
    """(cluster_id, representative, n_members, distance_sum): the member nearest to all others, least name on ties.

    classes: rep, n (samples it stands for, at distance 0), cluster_id; pairs: a, b, distance between reps. A pair
    that is not listed counts as `missing`.
    """
    total = classes.groupBy("cluster_id").agg(F.sum("n").alias("n_members"))
    one = classes.select(F.col("rep").alias("r"), "cluster_id", F.col("n").alias("own"))
    other = classes.select(F.col("rep").alias("o"), F.col("cluster_id").alias("c"), F.col("n").alias("weight"))
    both = pairs.select(F.col("a").alias("r"), F.col("b").alias("o"), "distance")
    both = both.unionByName(pairs.select(F.col("b").alias("r"), F.col("a").alias("o"), "distance"))
    known = both.join(one.select("r", "cluster_id"), "r").join(other, "o").filter("c = cluster_id")
    known = known.groupBy("r").agg(F.sum(F.col("distance") * F.col("weight")).alias("d"), F.sum("weight").alias("w"))
    rows = one.join(known, "r", "left").join(total, "cluster_id")
    rest = F.col("n_members") - F.col("own") - F.coalesce("w", F.lit(0))
    rows = rows.withColumn("distance_sum", F.round(F.coalesce("d", F.lit(0.0)) + F.lit(missing) * rest, 6))
    best = rows.groupBy("cluster_id").agg(F.min(F.struct("distance_sum", "r", "n_members")).alias("m"))
    return best.select("cluster_id", F.col("m.r").alias("representative"), "m.n_members", "m.distance_sum")
