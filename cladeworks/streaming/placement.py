"""Placing arriving genomes in the nearest known cluster, as a stream of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sketches import distance_pairs, sketch


def place(batch: DataFrame, known: DataFrame, k: int, size: int, threshold: float) -> DataFrame:
    """(sample, cluster_id, distance): nearest cluster of every row (sample, seq) of a batch, null beyond threshold.

    known: sample, cluster_id, sketch, with ids other than the batch's. The inverted index finds neighbours; the
    least distance wins, then the least cluster.
    """
    fresh = sketch(batch, "sample", "seq", k, size)
    both = known.select(F.col("sample").alias("rep"), "sketch").unionByName(fresh.select(F.col("sample").alias("rep"), "sketch")).withColumn("n", F.lit(1))
    pairs = distance_pairs(both, k, size, threshold)
    ends = pairs.select(F.col("a").alias("sample"), F.col("b").alias("other"), "distance").unionByName(pairs.select(F.col("b").alias("sample"), F.col("a").alias("other"), "distance"))
    near = ends.join(known.select(F.col("sample").alias("other"), "cluster_id"), "other").join(fresh.select("sample"), "sample", "left_semi")
    best = near.groupBy("sample").agg(F.min(F.struct("distance", "cluster_id")).alias("m"))
    return batch.select("sample").join(best, "sample", "left").select("sample", F.col("m.cluster_id").alias("cluster_id"), F.col("m.distance").alias("distance"))


def placement_stream(arrivals: DataFrame, known: DataFrame, out: str, checkpoint: str, k: int = 21, size: int = 1000, threshold: float = 0.03) -> StreamingQuery:
    """Place a stream of (sample, seq); each micro-batch goes to a folder of its own, so a repeated one overwrites itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        place(batch, known, k, size, threshold).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts of event types in time windows of a stream with event time `ts`; later rows than `delay` are dropped."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
