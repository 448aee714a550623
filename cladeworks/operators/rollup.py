"""Summaries of a run: per-cluster states, statistics, counts of sequence files, errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import confidence_tier, fixed, gubbins_status, tree_status


def id_spine(*frames: DataFrame, key: str = "cluster_id") -> DataFrame:
    """The distinct ids of all frames."""
    return reduce(DataFrame.unionByName, (f.select(key) for f in frames)).filter(F.col(key).isNotNull()).distinct()


def phylogeny_summary(sizes: DataFrame, diagnostics: DataFrame, trees: DataFrame, filtered: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row for each cluster that sizes, diagnostics or trees know, with its states and confidence tier.

    sizes: cluster_id, n_isolates; diagnostics: cluster_id and what sources.readers.diagnostics reads of a log; trees:
    cluster_id, tree_bytes, tree_text, log_bytes; filtered: cluster_id, n_records, n_columns of the filtered alignment;
    blocks: cluster_id, n_blocks. A cluster without diagnostics says so; one that no list of clusters has counts the
    records of its filtered alignment.
    """
    rows = id_spine(sizes, diagnostics, trees)
    for frame in (sizes, diagnostics.withColumn("has_log", F.lit(True)), trees, filtered, blocks):
        rows = rows.join(frame, "cluster_id", "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))
    status = gubbins_status(F.coalesce("skipped", F.lit(False)), F.coalesce("failed", F.lit(False)), F.col("code"))
    status = F.when(F.col("has_log").isNull(), F.lit("no_diagnostics")).otherwise(status)
    tree = tree_status(F.col("tree_bytes"), F.coalesce("tree_text", F.lit("")), F.coalesce(F.col("seq_count").cast("bigint"), F.lit(3)), F.col("log_bytes"))
    n = F.coalesce(F.col("n_isolates"), whole("n_records"))
    rows = rows.select(
        "cluster_id", n.alias("n_isolates"), text("alignment_length").alias("alignment_length"), text("seq_count").alias("seq_count_in_alignment"),
        F.when(F.coalesce("starting_tree", F.lit(False)), "true").otherwise("false").alias("starting_tree_present"), status.alias("gubbins_status"), text("code").alias("gubbins_exit_code"),
        whole("n_blocks").alias("n_recombination_blocks"), whole("n_columns").alias("n_filtered_polymorphic_sites"), tree.alias("iqtree_status"),
        whole("tree_bytes").alias("treefile_size_bytes"), whole("log_bytes").alias("iqtree_log_size_bytes"),
        F.when(F.coalesce("empty_input", F.lit(False)), "input_alignment_empty").otherwise("").alias("notes"),
    )
    tier = confidence_tier(F.col("n_isolates"), F.col("gubbins_status"), F.col("iqtree_status"), F.col("n_filtered_polymorphic_sites"))
    return rows.withColumn("confidence_tier", tier)


def alignment_sizes(alignment: DataFrame) -> DataFrame:
    """(cluster_id, n_sequences, alignment_length, n_columns): all characters, and those of one sequence."""
    return alignment.groupBy("cluster_id").agg(
        F.count("*").alias("n_sequences"), F.sum(F.length("seq")).cast("bigint").alias("alignment_length"), F.max(F.length("seq")).cast("bigint").alias("n_columns")
    )


def fasta_counts(records: DataFrame) -> DataFrame:
    """(path, n_records, n_columns): records of each sequence file, and the length of its first; records: of readers.fasta."""
    return records.groupBy("path").agg(F.count("*").alias("n_records"), F.min_by(F.length("seq"), "contig_ord").cast("bigint").alias("n_columns"))


def interval_counts(lines: DataFrame) -> DataFrame:
    """(path, n_blocks) of annotation files (path, value): lines that are neither blank nor comments."""
    return lines.groupBy("path").agg(F.count_if((F.trim("value") != "") & ~F.startswith("value", F.lit("#"))).alias("n_blocks"))


def statistics(**metrics: tuple[DataFrame, Column]) -> DataFrame:
    """(metric, value): one row for each named aggregate, all as text."""
    return reduce(DataFrame.unionByName, (frame.agg(column.cast("string").alias("value")).select(F.lit(name).alias("metric"), "value") for name, (frame, column) in metrics.items()))


def _stacked(row: DataFrame, metrics: list[tuple[str, str]]) -> DataFrame:
    """(place, metric, value) of one row's columns."""
    cells = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(m).alias("metric"), F.coalesce(F.col(c), F.lit("0")).alias("value")) for i, (m, c) in enumerate(metrics)))
    return row.select(F.explode(cells).alias("x")).select("x.place", "x.metric", "x.value")


def analysis_statistics(members: DataFrame, snps: DataFrame, trees: DataFrame) -> DataFrame:
    """(place, metric, value), 16 rows. members: cluster_id; snps: total_snps of each sample; trees: n_leaves of each tree."""
    n = F.col("n")
    text = lambda c: c.cast("string")
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("n"))
    one = sizes.agg(
        text(F.coalesce(F.sum(n), F.lit(0))).alias("samples"), text(F.count("*")).alias("clusters"), fixed(F.avg(n), 2).alias("mean"), text(F.max(n)).alias("most"), text(F.min(n)).alias("least"),
        text(F.count_if(n == 1)).alias("single"), text(F.count_if(n.between(2, 5))).alias("small"), text(F.count_if(n.between(6, 20))).alias("medium"), text(F.count_if(n > 20)).alias("large"),
    )
    t, leaves = F.col("total_snps"), F.col("n_leaves")
    two = snps.agg(text(F.sum(t)).alias("snps"), fixed(F.avg(t), 2).alias("mean_snps"), text(F.max(t)).alias("most_snps"), text(F.min(t)).alias("least_snps"))
    three = trees.agg(text(F.count("*")).alias("trees"), fixed(F.avg(leaves), 2).alias("mean_leaves"), text(F.sum(leaves)).alias("leaves"))
    row = one.crossJoin(F.broadcast(two)).crossJoin(F.broadcast(three))  # one row each
    # The names of the metrics, in their order.
    metrics = [
        ("Total Samples", "samples"), ("Total Clusters", "clusters"), ("Average Cluster Size", "mean"), ("Largest Cluster", "most"), ("Smallest Cluster", "least"),
        ("Singleton Clusters", "single"), ("Small Clusters (2-5 samples)", "small"), ("Medium Clusters (6-20 samples)", "medium"), ("Large Clusters (>20 samples)", "large"),
        ("Total Phylogenetic Trees", "trees"), ("Total SNP Positions", "snps"), ("Average SNPs per Sample", "mean_snps"), ("Maximum SNPs per Sample", "most_snps"),
        ("Minimum SNPs per Sample", "least_snps"), ("Average Tree Size (leaves)", "mean_leaves"), ("Total Tree Leaves", "leaves"),
    ]
    return _stacked(row, metrics)


def integrated_report(mapping: DataFrame) -> DataFrame:
    """One row: samples in the phylogeny, and clusters that they are from; mapping: sample_id, cluster_id."""
    return mapping.agg(F.count("*").alias("n_samples"), F.countDistinct("cluster_id").alias("n_clusters"))


def failed_tasks(lines: DataFrame) -> DataFrame:
    """(folder, sample, process, error, retried) of failed work folders, from (folder, file, line_no, value) of their logs.

    sample and process stand in the run script, the error is the last line of the error log without coloured parts; an exit
    code that is tried again is not an error by itself.
    """
    run, err = F.col("file") == ".command.run", F.col("file") == ".command.err"
    first = lambda pattern, cue: F.min_by(F.regexp_extract("value", pattern, 1), F.when(run & F.contains("value", F.lit(cue)), F.col("line_no")))
    code = F.max(F.when(F.col("file") == ".exitcode", F.trim("value")))
    rows = lines.groupBy("folder").agg(
        first(r"\(([^)]*)\)", "nf-").alias("sample"), first(r":([^:\s]+)[^:]*$", "NEXTFLOW TASK").alias("process"),
        F.max_by(F.regexp_replace("value", r"\[[^\]\[]*\]", ""), F.when(err, F.col("line_no"))).alias("error"), code.alias("code"),
    )
    return rows.select("folder", "sample", "process", "error", F.coalesce(F.col("code").isin(*RETRIED), F.lit(False)).alias("retried"))


# Exit codes after which a task is tried again.
RETRIED = ("0", "143", "137", "104", "134", "139", "71", "255")


def error_rollup(errors: DataFrame, order: str) -> DataFrame:
    """The first by `order` of rows with equal sample, process, error and run; rows without sample go.

    errors: sample, process, error, folder, run and the column of `order`.
    """
    keys = ["sample", "process", "error", "run"]
    rows = errors.filter(F.coalesce(F.col("sample"), F.lit("")) != "")
    first = rows.groupBy(*keys).agg(F.min_by("folder", order).alias("folder"), F.min(order).alias(order))
    return first.select("sample", "process", "error", "folder", "run", order)


def n_results(pairs: DataFrame) -> DataFrame:
    """One row: how many result rows there are."""
    return pairs.agg(F.count("*").alias("num_results"))
