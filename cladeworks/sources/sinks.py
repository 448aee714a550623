"""Writers. A folder of part files is the native form; `one` asks for a single file of a small result."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.trees import write_trees


def table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, one: bool = False, order: list | None = None) -> None:
    """Delimited text; with `order`, sorted over all parts."""
    df = df.orderBy(*order) if order else df
    (df.coalesce(1) if one else df).write.mode("overwrite").csv(path, sep=sep, header=header, emptyValue="")


def fasta(df: DataFrame, path: str, name: str = "seq_id", seq: str = "seq") -> None:
    """FASTA records; empty sequences are left out."""
    text = F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.col(seq))
    df.filter(F.length(seq) > 0).select(text.alias("value")).write.mode("overwrite").text(path)


def representatives_fasta(df: DataFrame, path: str) -> None:
    """Sequences under their representative's name; a placeholder where there is none."""
    rows = df.select(F.col("representative").alias("seq_id"), "seq")
    if rows.isEmpty():
        rows = df.sparkSession.createDataFrame([("dummy_representative", "N")], "seq_id string, seq string")
    fasta(rows, path)


def matrix(edges: DataFrame, path: str, names: DataFrame | None = None) -> None:
    """A labelled square matrix (ref, query, distance), rows and columns in order of name; a missing pair is empty.

    A row is put together from its own pairs, so a task holds one row; no pivot, and no names on the driver. names: all
    labels (name), if edges lack some. The list of names is in every row of the result, so the text is quadratic by nature.
    """
    both = edges.select(F.col("ref").alias("name")).unionByName(edges.select(F.col("query").alias("name")))
    every = (names.select("name") if names is not None else both).distinct()
    header = every.agg(F.sort_array(F.collect_list("name")).alias("names"))  # one row: the header line itself
    cells = edges.filter("distance is not null").groupBy("ref").agg(F.map_from_entries(F.collect_list(F.struct("query", "distance"))).alias("of"))
    rows = every.join(cells, F.col("name") == F.col("ref"), "left").crossJoin(F.broadcast(header))
    of = F.transform("names", lambda q: F.coalesce(F.element_at("of", q).cast("string"), F.lit("")))
    lines = rows.select(F.lit(1).alias("k"), F.col("name").alias("n"), F.concat_ws("\t", F.col("name").cast("string"), of).alias("value"))
    top = header.select(F.lit(0).alias("k"), F.lit(None).cast(every.schema["name"].dataType).alias("n"), F.concat_ws("\t", F.lit(""), F.transform("names", lambda q: q.cast("string"))).alias("value"))
    top.unionByName(lines).orderBy("k", "n").select("value").coalesce(1).write.mode("overwrite").text(path)


def pair_table(pairs: DataFrame, path: str) -> None:
    """Pairs by distance, those of a sample with itself last."""
    rows = pairs.orderBy("is_self", "n_snps", "sample_a", "sample_b").select("sample_a", "sample_b", F.col("n_snps").alias("Number_core_SNPs_apart"))
    table(rows, path)


def samplesheet(rows: DataFrame, path: str) -> None:
    """sample, file: study rows first, then the selected in order of sample."""
    table(rows.orderBy("part", F.when(F.col("part") == 1, F.col("sample")), "file").select("sample", "file"), path, sep=",", one=True)


def country_summary(rows: DataFrame, path: str) -> None:
    """Largest country first."""
    table(rows, path, one=True, order=[F.desc("n_input"), "country"])


def text_lines(rows: DataFrame, path: str, column: str = "line") -> None:
    rows.select(F.col(column).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def graft_log(report: DataFrame, path: str) -> None:
    """A line for each cluster's grafting, then counts for each tree."""
    rows = report.select("tree_id", F.lit(0).alias("k"), "cluster_id", F.concat_ws("\t", "tree_id", "cluster_id", "representative", "status").alias("line"))
    counts = report.groupBy("tree_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "grafted").alias("good"))
    total = counts.select("tree_id", F.lit(1).alias("k"), F.lit("").alias("cluster_id"), F.format_string("%s: %d cluster trees, %d grafted, %d not", "tree_id", "n", "good", F.col("n") - F.col("good")).alias("line"))
    text_lines(rows.unionByName(total).orderBy("tree_id", "k", "cluster_id"), path)


def integration_summary(row: DataFrame, per_cluster: DataFrame, path: str) -> None:
    """The counts of alignments.integration_summary, then SNPs of each cluster (cluster_id, n)."""
    top = row.select(F.lit(0).alias("k"), F.lit("").alias("c"), F.format_string("%d samples, %d clusters, %d positions; integrated length %d, on average %s", "n_samples", "n_clusters", "total_positions", "longest", "average").alias("line"))
    rest = per_cluster.select(F.lit(1).alias("k"), F.col("cluster_id").cast("string").alias("c"), F.format_string("Cluster %s: %d SNPs", F.col("cluster_id").cast("string"), "n").alias("line"))
    text_lines(top.unionByName(rest).orderBy("k", "c"), path)


def split_fasta(records: DataFrame, folder: str) -> None:
    """One folder of FASTA text for each header: name=<header's first word>."""
    name = F.substring_index("header", " ", 1)
    text = F.concat(F.lit(">"), F.col("header"), F.lit("\n"), F.col("seq"))
    records.select(name.alias("name"), text.alias("value")).repartition("name").write.mode("overwrite").partitionBy("name").text(folder)


def alignment_digest(alignment: DataFrame) -> DataFrame:
    """(cluster_id, md5) of each alignment in order of seq_id: equal alignments need no second run."""
    each = alignment.select("cluster_id", F.struct("seq_id", F.md5(F.upper("seq")).alias("m")).alias("x"))
    return each.groupBy("cluster_id").agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: F.concat_ws(":", x["seq_id"].cast("string"), x["m"])), ",")).alias("md5"))


#: Where results of a run go, by kind of result.
LAYOUT = {"clusters": "Clusters", "distances": "Distances", "alignments": "Alignments", "recombination": "Recombination", "trees": "Trees", "summaries": "Summaries", "run": "pipeline_info"}


def publish(frames: dict[str, DataFrame], folder: str, rename: dict[str, str] | None = None, log=print) -> dict[str, int]:
    """Write frames named kind/name as tables below a folder in LAYOUT, tell `log` of each, and return rows by path."""
    out = {}
    for name, frame in frames.items():
        kind, _, rest = name.partition("/")
        if kind not in LAYOUT or not rest:
            raise ValueError(f"{name} is not kind/name with a kind of {', '.join(LAYOUT)}")
        path = f"{folder}/{LAYOUT[kind]}/{(rename or {}).get(name, rest)}.tsv"
        table(frame, path)
        out[path] = frame.sparkSession.read.csv(path, sep="\t", header=True).count()
        log(f"{name}: {out[path]} rows -> {path}")
    return out


def newick(edges: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    trees = write_trees(edges)
    if not dry_run:
        trees.select(F.col("newick").alias("value")).write.mode("overwrite").text(path)
    return trees


def cluster_tables(members: DataFrame, folder: str) -> None:
    """clusters, cluster_membership and cluster_sizes."""
    table(members, f"{folder}/clusters", order=["cluster_id", "sample_id"])
    table(members.groupBy("cluster_id").agg(F.count("*").alias("n_isolates")), f"{folder}/cluster_sizes", one=True, order=[F.desc("n_isolates"), "cluster_id"])


def joined(frames: list[DataFrame], path: str) -> None:
    """Tables of one schema as one, in the order given, with one header."""
    whole = None
    for i, f in enumerate(frames):
        f = f.withColumn("__source", F.lit(i))
        whole = f if whole is None else whole.unionByName(f)
    table(whole.orderBy("__source").drop("__source"), path, one=True)


def vcf(rows: DataFrame, path: str) -> None:
    """Sites as VCF lines, header first."""
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    lines = rows.select(F.lit(1).alias("k"), "cluster_id", "pos", F.concat_ws("\t", "cluster_id", "pos", F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.concat(F.lit("NR="), "n_ref", F.lit(";NA="), "n_alt")).alias("value"))
    top = rows.sparkSession.createDataFrame([(0, None, i, v) for i, v in enumerate(head)], "k int, cluster_id bigint, pos int, value string")
    top = top.select("k", F.col("cluster_id").cast(rows.schema["cluster_id"].dataType).alias("cluster_id"), "pos", "value")
    top.unionByName(lines).orderBy("k", "cluster_id", "pos").select("value").write.mode("overwrite").text(path)


def report(statistics: DataFrame, title: str) -> tuple[str, str]:
    """The (metric, value) rows, a few dozen by nature, as plain text and as HTML."""
    order = ["place"] if "place" in statistics.columns else ["metric"]
    rows = [(r["metric"], r["value"]) for r in statistics.orderBy(*order).collect()]
    text = "\n".join([title, "=" * len(title), *(f"{m}: {v}" for m, v in rows)]) + "\n"
    cells = "".join(f"<tr><td>{html.escape(m)}</td><td>{html.escape(str(v))}</td></tr>" for m, v in rows)
    return text, f"<html><body><h1>{html.escape(title)}</h1><table>{cells}</table></body></html>"


def versions(rows: DataFrame, path: str) -> None:
    """Distinct (process, tool, version) as YAML."""
    lines = rows.distinct().groupBy("process").agg(F.sort_array(F.collect_list(F.concat(F.lit("    "), "tool", F.lit(": "), "version"))).alias("x"))
    lines.orderBy("process").select(F.concat(F.col("process"), F.lit(":\n"), F.array_join("x", "\n")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def workbook(tables: dict[str, DataFrame], path: str, most: int = 1_000_000) -> None:
    """A spreadsheet with a sheet for each table. A spreadsheet holds few rows, so larger tables are refused."""
    import pandas as pd

    with pd.ExcelWriter(path) as writer:
        for name, frame in tables.items():
            if len(rows := frame.limit(most + 1).toPandas()) > most:
                raise ValueError(f"{name} has more rows than a sheet")
            rows.to_excel(writer, sheet_name=name[:31], index=False)


def workbooks(folder: str, frames: dict[str, DataFrame]) -> None:
    """A spreadsheet beside each table, its sheet named by the last part of the table's name between dots."""
    for name, frame in frames.items():
        workbook({name.split(".")[-1]: frame}, f"{folder}/{name}.xlsx")


def preview(df: DataFrame, n: int = 20, log=print) -> None:
    """Tell `log` of the first rows and how many more there are."""
    rows = df.limit(n + 1).collect()
    for r in rows[:n]:
        log("\t".join("" if v is None else str(v) for v in r))
    if len(rows) > n:
        log(f"... and {df.count() - n} more")
