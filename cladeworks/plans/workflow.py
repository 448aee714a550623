"""Linking clusters with assemblies, representatives and references, and plans that settings choose."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import accession_key, normalize_name
from ..operators import alignments as al
from ..operators import recombination as rec
from ..operators.clusters import sizes
from ..operators.qc import require_unique
from ..operators.trees import nj_trees
from .settings import Settings


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left joined with right on a key that is unique in both, as a match of channels is; a repeated key is an error."""
    return require_unique(left, key).join(require_unique(right, key), key)


def cluster_assemblies(members: DataFrame, assemblies: DataFrame, least: int = 3) -> DataFrame:
    """(cluster_id, sample_ids, files): samples and files in order of sample, for clusters of at least so many.

    members: cluster_id, sample_id; assemblies: sample_id, file, one each. A sample without assembly is left out.
    """
    rows = members.join(require_unique(assemblies, "sample_id"), "sample_id")
    both = F.sort_array(F.collect_list(F.struct("sample_id", "file")))
    rows = rows.groupBy("cluster_id").agg(both.alias("x")).filter(F.size("x") >= least)
    return rows.select("cluster_id", F.transform("x", lambda r: r["sample_id"]).alias("sample_ids"), F.transform("x", lambda r: r["file"]).alias("files"))


def unzipped(clusters: DataFrame) -> DataFrame:
    """(cluster_id, sample_id, file): the parallel lists of cluster_assemblies as rows."""
    return clusters.select("cluster_id", F.explode(F.arrays_zip("sample_ids", "files")).alias("x")).select("cluster_id", F.col("x.sample_ids").alias("sample_id"), F.col("x.files").alias("file"))


def with_reference(clusters: DataFrame, reference: DataFrame) -> DataFrame:
    """Every cluster with the one global reference (name); a second reference is an error."""
    if reference.limit(2).count() != 1:
        raise ValueError("one global reference is needed")
    return clusters.crossJoin(F.broadcast(reference))  # a single row


def representative_files(representatives: DataFrame, files: DataFrame) -> DataFrame:
    """(cluster_id, representative, file, match): the assembly of each representative among its cluster's files.

    The file whose name is the representative's, else one that is its but for the version, else the cluster's first; of
    several the least name. representatives: cluster_id, representative; files: cluster_id, file.
    """
    name, bare = normalize_name(F.col("file")), accession_key(F.col("file"))
    wanted = accession_key(F.col("representative"))
    place = F.when(name == F.col("representative"), 1).when((bare == F.col("representative")) | (bare == wanted), 2).otherwise(3)
    rows = representatives.join(files, "cluster_id", "left").withColumn("place", F.when(F.col("file").isNotNull(), place))
    best = rows.groupBy("cluster_id", "representative").agg(F.min(F.struct("place", "file")).alias("m"))
    kind = F.element_at(F.array(F.lit("exact"), F.lit("version"), F.lit("any")), F.col("m.place"))
    return best.select("cluster_id", "representative", "m.file", F.coalesce(F.when(F.col("m.place").isNotNull(), kind), F.lit("none")).alias("match"))


def alignment_references(clusters: DataFrame, representatives: DataFrame, s: Settings, reference: DataFrame | None = None) -> DataFrame:
    """clusters with representative and the file that they are aligned to: the global reference, if settings say so."""
    rows = one_to_one(clusters, representatives.select("cluster_id", "representative", "file"), "cluster_id")
    if s.use_global_reference and reference is not None:
        return with_reference(rows.drop("file"), reference.select(F.col("file").alias("aligned_to")))
    return rows.withColumnRenamed("file", "aligned_to")


#: What each tool's intervals are called in tables.
TOOLS = {"gubbins": "Gubbins", "clonalframeml": "ClonalFrameML"}


def tools_of(s: Settings) -> list[str]:
    return list(TOOLS) if s.recombination == "both" else [t for t in TOOLS if t == s.recombination]


def masked_alignments(alignment: DataFrame, intervals: dict[str, DataFrame], closure: DataFrame, s: Settings) -> DataFrame:
    """(tool, cluster_id, seq_id, seq): the alignment masked by each tool that settings name; `none` passes it through.

    intervals: tool -> (node, start, stop); closure: (node, tip). A node that the tree lacks is an error.
    """
    tools = tools_of(s)
    if not tools:
        return alignment.select(F.lit("none").alias("tool"), "cluster_id", "seq_id", "seq")
    if missing := [t for t in tools if t not in intervals]:
        raise ValueError(f"no intervals of {', '.join(missing)}")
    out = []
    for tool in tools:
        rec.require_known_nodes(intervals[tool], closure)
        masked = rec.mask(alignment, rec.tip_intervals(intervals[tool], closure).withColumn("tip", F.col("tip").cast(alignment.schema["seq_id"].dataType)))
        out.append(masked.join(alignment.select("seq_id", "cluster_id"), "seq_id").select(F.lit(TOOLS[tool]).alias("tool"), "cluster_id", "seq_id", "seq"))
    return reduce(DataFrame.unionByName, out)


def enough(alignment: DataFrame, least: int = 3) -> DataFrame:
    """(cluster_id, n_isolates, route): clusters of fewer sequences are not analysed, and say so."""
    n = F.col("n_isolates")
    return sizes(alignment).withColumn("route", F.when(n < least, "skipped_low_information").otherwise("analysed"))


def recombination_aware(s: Settings, alignment: DataFrame, intervals: dict[str, DataFrame], closure: DataFrame) -> dict[str, DataFrame]:
    """The plan that settings choose, from an alignment to trees; frames by name, none of them run yet.

    Clusters of fewer than three sequences are in `routes` only. For each tool: masked alignment, core SNPs, distances and a
    tree of every cluster.
    """
    routes = enough(alignment)
    rows = alignment.join(routes.filter("route = 'analysed'").select("cluster_id"), "cluster_id", "left_semi")
    if s.mode == "recombination_aware":  # columns of A, C, G and T only
        rows = al.atcg_sequences(rows, al.atcg_columns(rows))
    masked = masked_alignments(rows, intervals, closure, s)
    by_tool = masked.select(F.concat_ws("/", "tool", F.col("cluster_id").cast("string")).alias("cluster_id"), "seq_id", "seq")
    positions = al.core_snp_positions(by_tool)
    classes = al.sequence_classes(by_tool)
    distances = al.snp_distances(classes)
    trees = nj_trees(distances.withColumnRenamed("n_snps", "distance"), classes.select("cluster_id", F.col("rep").alias("name")))
    return {"routes": routes, "masked": masked, "positions": positions, "distances": distances, "trees": trees}
