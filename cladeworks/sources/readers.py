"""Readers of sequence files, sheets, distances, intervals, trees and logs. All schemas are declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import has_ending, normalize_name
from ..operators.qc import require_rows, require_unique

MASH = "ref string, query string, distance double, p_value double, shared_hashes string"
SHEET = "sample string, file string"


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample, file) of a .csv, .tsv or spreadsheet file with exactly these two columns and no repeated sample."""
    if path.lower().endswith((".xlsx", ".xls", ".ods")):
        return require_unique(spreadsheet(spark, path))
    sep = "\t" if path.lower().endswith((".tsv", ".txt")) else ","
    rows = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    if len(rows.columns) != 2:
        raise ValueError(f"a sample sheet has 2 columns, this one {len(rows.columns)}")
    rows = rows.toDF("sample", "file")
    bad = rows.filter(F.col("sample").isNull() | F.col("file").isNull() | F.col("sample").rlike(r"\s") | ~has_ending(F.col("file")))
    if found := bad.limit(3).collect():
        raise ValueError(f"sample sheet rows that are no sample and sequence file: {found}")
    return require_unique(rows)


def spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample, file) of a spreadsheet; spaces in headers become _, line breaks in cells spaces. Needs pandas' engine."""
    import pandas as pd

    frame = pd.read_excel(path, dtype=str)
    frame.columns = [str(c).strip().replace(" ", "_") for c in frame.columns]
    rows = spark.createDataFrame(frame.fillna("").values.tolist(), ", ".join(f"`{c}` string" for c in frame.columns))
    return clean_cells(rows).toDF("sample", "file")


def clean_cells(df: DataFrame) -> DataFrame:
    return df.select(*(F.regexp_replace(F.col(f"`{c}`"), r"[\r\n]+", " ").alias(c.replace(" ", "_")) for c in df.columns))


def sequence_files(spark: SparkSession, folder: str, recursive: bool = True, gz: bool = True) -> DataFrame:
    """(path, size) of the sequence files of a folder, without reading them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    rows = reader.load(folder).select("path", F.col("length").alias("size"))
    return require_rows(rows.filter(has_ending(F.col("path"), gz=gz)), "sequence file").orderBy("path")


def guarded(files: DataFrame, path: str = "path") -> DataFrame:
    """files, or an error: paths with blanks, of no sequence file, or two files of one base name."""
    name = normalize_name(F.regexp_replace(path, r"\.gz$", ""))
    odd = files.filter(F.col(path).rlike(r"\s") | ~has_ending(F.col(path))).select(F.col(path).alias("p"))
    twice = files.groupBy(name.alias("p")).agg(F.count("*").alias("n")).filter("n > 1").select("p")
    for what, rows in (("with blanks or of no sequence file", odd), ("of one base name", twice)):
        if found := rows.limit(5).collect():
            raise ValueError(f"files {what}: " + ", ".join(r["p"] for r in found))
    return files


def fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(sample, path, contig_ord, header, seq) of FASTA files, gzipped ones too; a record is one row.

    Files are split at record starts, so a large file spreads over tasks (a gzipped one cannot). Records are numbered by
    block of the file: a row for each block says how many records come before it, so no task needs a whole file.
    """
    text = spark.read.option("lineSep", "\n>").text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    value = F.regexp_replace("value", "^>", "")
    lines = F.split(F.replace(value, F.lit("\r"), F.lit("")), "\n", 2)
    rows = text.filter(F.length(F.trim("value")) > 0).select("path", "block", "at", F.trim(lines[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(lines, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))
    blocks = rows.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("path", "block", "first", "before")
    # numbers of a block follow each other in its task, blank records between them aside
    inside = F.row_number().over(Window.partitionBy("path", "block").orderBy("at"))
    rows = rows.withColumn("k", inside).join(blocks, ["path", "block"])
    return rows.select(normalize_name(F.regexp_replace("path", r"\.gz$", "")).alias("sample"), "path", (F.col("before") + F.col("k")).cast("int").alias("contig_ord"), "header", "seq")


def alignments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(cluster_id, seq_id, seq) of ready alignments, one FASTA file for each cluster; the file's name is the cluster's."""
    rows = fasta(spark, paths)
    return rows.select(F.regexp_replace("sample", r"\.(core|aln|filtered_polymorphic_sites)$", "").alias("cluster_id"), F.substring_index("header", " ", 1).alias("seq_id"), "seq")


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, value) of the lines of files."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """paths, or an error that names those that are not there; any store that Spark reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(conf).globStatus(p)
        if found is None or not len(found):
            missing.append(path)
    if missing:
        raise ValueError("no such input: " + ", ".join(missing))
    return paths


def cluster_ids(spark: SparkSession, diagnostics_dir: str, trees_dir: str) -> DataFrame:
    """(cluster_id): named by the logs of one folder and the trees of another, in order."""
    listed = lambda folder, suffix: (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select(F.replace(F.element_at(F.split("path", "/"), -1), F.lit(suffix), F.lit("")).alias("cluster_id"))
    )
    return listed(diagnostics_dir, ".diagnostics.log").union(listed(trees_dir, ".final.treefile")).distinct().orderBy("cluster_id")


def mash_table(spark: SparkSession, path: str) -> DataFrame:
    """The five columns of a distance table without header; rows without names are dropped."""
    return spark.read.csv(path, sep="\t", schema=MASH).filter(F.col("ref").isNotNull() & F.col("query").isNotNull())


def distance_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(ref, query, distance) of a labelled square matrix; what is no number is missing."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    first, *rest = rows.columns
    long = rows.unpivot([first], rest, "query", "value") if rest else rows.select(first, F.lit(None).alias("query"), F.lit(None).alias("value"))
    return long.select(F.col(first).alias("ref"), "query", F.col("value").try_cast("double").alias("distance")).filter(F.col("distance").isNotNull() & ~F.isnan("distance"))


def distances(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, distance) of a long table or of a lower triangle, told apart by a first line that is a number only.

    A long table needs three fields; pairs of a name with itself are dropped.
    """
    lines = spark.read.text(path)
    head = lines.limit(1).collect()
    if head and head[0][0].strip().isdigit():
        return _triangle(lines)
    parts = F.split("value", "\t")
    rows = lines.filter(F.size(parts) >= 3).select(parts[0].alias("a"), parts[1].alias("b"), parts[2].try_cast("double").alias("distance"))
    return rows.filter("a <> b and distance is not null")


def _triangle(lines: DataFrame) -> DataFrame:
    parts = F.split(F.trim("value"), r"\t")
    # the number of fields of a row is its place in the triangle
    rows = lines.filter(~F.col("value").rlike(r"^\s*\d+\s*$") & (F.length(F.trim("value")) > 0)).select(parts[0].alias("a"), F.slice(parts, 2, F.size(parts)).alias("d"))
    named = rows.withColumn("i", F.size("d"))
    cells = named.select("a", F.posexplode("d").alias("j", "value"))
    pairs = cells.join(named.select(F.col("a").alias("b"), F.col("i").alias("j")), "j")
    return pairs.select("a", "b", F.col("value").try_cast("double").alias("distance")).filter("distance is not null")


def metadata(spark: SparkSession, path: str, country: str = "Country_Final", subregion: str = "Subregion", ids: tuple[str, ...] = ("FASTA_name", "Assembly Accession", "sample_id"), date: str = "final_collection_dates") -> DataFrame:
    """Metadata rows as text; country, subregion and at least one id column have to be there."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    missing = [c for c in (country, subregion) if c not in rows.columns]
    if missing or not any(c in rows.columns for c in ids):
        raise ValueError(f"metadata lacks {missing or 'every id column of ' + ', '.join(ids)}")
    some = lambda c: F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string")
    return rows.select(F.monotonically_increasing_id().alias("line"), some(ids[0]).alias("fasta_name"), some(ids[1]).alias("accession"), some(ids[2]).alias("sample"), some(country).alias("country"), some(subregion).alias("subregion"), some(date).alias("date"))


def clonalframe_intervals(spark: SparkSession, path: str) -> DataFrame:
    """(node, start, stop), 0-based half-open, of a table `Node Beg End`."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).filter(~F.col("value").rlike("^Node.*Beg.*End$") & (F.size(parts) >= 3))
    return rows.select(parts[0].alias("node"), (parts[1].cast("int") - 1).alias("start"), parts[2].cast("int").alias("stop"))


def gff_intervals(spark: SparkSession, path: str) -> DataFrame:
    """(node, start, stop), 0-based half-open, of GFF lines whose attributes name the node after an arrow."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.startswith("value", F.lit("##")) & (F.size(parts) >= 9))
    return rows.select(F.regexp_extract(parts[8], '->([^";]+)"', 1).alias("node"), (parts[3].cast("int") - 1).alias("start"), parts[4].cast("int").alias("stop"))


def newick_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(tree_id, newick, path) of tree files; a path that is given twice counts once."""
    rows = spark.read.text(list(dict.fromkeys(paths)), wholetext=True).select(F.col("value").alias("newick"), F.col("_metadata.file_path").alias("path"))
    return rows.filter(F.length(F.trim("newick")) > 0).dropDuplicates(["path"]).select(normalize_name(F.col("path")).alias("tree_id"), "newick", "path")


def representatives(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, representative), also under the alias <cluster_id>.final; # begins a comment."""
    rows = spark.read.csv(path, sep="\t", schema="cluster_id string, representative string", comment="#").filter("cluster_id is not null and representative is not null")
    return rows.select(F.explode(F.array("cluster_id", F.concat("cluster_id", F.lit(".final")))).alias("cluster_id"), F.trim("representative").alias("representative"))


def clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="cluster_id string, sample_id string")


def qc_checks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="sample string, qc_step string, outcome string")


def diagnostics(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, cluster_id, seq_count, alignment_length, starting_tree, skipped, failed, code, empty_input) of logs."""
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    return diagnostics_of(rows).withColumn("cluster_id", F.replace(F.element_at(F.split("path", "/"), -1), F.lit(".diagnostics.log"), F.lit("")))


def diagnostics_of(lines: DataFrame) -> DataFrame:
    """What the lines (path, value) of each log say, a row for each path; counts are null where no line has them."""
    found = lambda pattern: F.max(F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")))
    begins = lambda text: F.max(F.startswith("value", F.lit(text)))
    return lines.groupBy("path").agg(
        found(r"^Sequence count:\s*(\d+)").cast("bigint").alias("seq_count"), found(r"^Alignment length \(non-header chars\):\s*(\d+)").cast("bigint").alias("alignment_length"),
        (found(r"^Starting tree present:.*\((\d+) bytes\)").isNotNull() & ~begins("Starting tree: (none provided)")).alias("starting_tree"),
        F.max(F.contains("value", F.lit("skipping Gubbins"))).alias("skipped"), begins("ERROR: Gubbins failed").alias("failed"),
        found(r"^Gubbins exit code:\s*(\S+)").alias("code"), begins("ERROR: Alignment file missing or empty").alias("empty_input"),
    )


def result_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of all result tables but those of the run itself."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tsv").load(folder).select("path")
    return rows.filter(~F.contains("path", F.lit("pipeline_info")))
