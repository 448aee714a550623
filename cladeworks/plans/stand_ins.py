"""Domain relations on the driver's tables: documents are genomes, embeddings alignments, nations trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K, SIZE, THRESHOLD, FAR = 12, 64, 0.02, 0.25


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, path, name, country, subregion, date, size. Subregions differ in case and blanks, some say nothing."""
    d = read(spark, sf_dir, "documents")
    number = F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit("."), (F.col("doc_id") % 4).cast("string"))
    name = F.concat(F.when(F.col("doc_id") % 6 == 0, "gcf_").when(F.col("doc_id") % 3 == 0, "GCF_").otherwise("GCA_"), number)
    date = F.when(F.col("doc_id") % 7 == 0, F.lit("unknown")).when(F.col("doc_id") % 7 == 1, F.concat(F.lit("May "), (1990 + F.col("n_chars") % 30).cast("string"))).otherwise(F.concat((1990 + F.col("n_chars") % 30).cast("string"), F.lit("-05")))
    subregion = F.when(F.col("doc_id") % 5 == 0, F.lit("NA")).when(F.col("doc_id") % 11 == 0, F.lit(" Unknown")).when(F.col("doc_id") % 4 == 0, F.upper("source")).when(F.col("doc_id") % 4 == 1, F.concat(F.lit(" "), "source", F.lit(" ")))
    return d.select(
        F.col("doc_id").alias("sample"), F.concat(F.lit("/in/"), "source", F.lit("/"), name, F.lit(".fasta")).alias("path"), name.alias("name"), F.col("lang").alias("country"),
        subregion.otherwise(F.col("source")).alias("subregion"), date.alias("date"), F.col("n_chars").alias("size"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, accession, fasta_name, sample, country, subregion, date: ids of another version or spelling, some rows without any
    of a genome's, and later rows of ids that were there before."""
    g = genomes(spark, sf_dir).withColumn("k", F.col("sample"))
    version, stem = (F.col("k") % 4 + 1).cast("string"), F.substring_index("name", ".", 1)
    accession = F.when(F.col("k") % 2 == 0, F.concat(stem, F.lit("."), version, F.lit(".fasta")))
    spelled = F.when(F.col("k") % 3 == 1, F.concat(F.translate("name", ".", "_"), F.lit(".fasta")))
    sample = F.when(F.col("k") % 5 == 0, F.concat(F.lit(" "), "name", F.lit(".fa")))
    country = F.when(F.col("k") % 11 == 0, F.lit(" ")).otherwise(F.concat("country", F.lit(" ")))
    first = g.select((F.col("k") * 2).alias("line"), accession.alias("accession"), spelled.alias("fasta_name"), sample.alias("sample"), country.alias("country"), "subregion", "date")
    again = g.filter(accession.isNotNull()).select((F.col("k") * 2 + 1).alias("line"), F.lit(None).cast("string").alias("accession"), accession.alias("fasta_name"), F.lit("").alias("sample"), F.lit("elsewhere").alias("country"), F.lit("x").alias("subregion"), F.lit("1980").alias("date"))
    return first.unionByName(again)


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path of study isolates: a file for each nation."""
    return read(spark, sf_dir, "nation").select(F.concat(F.lit("/study/"), "n_name", F.lit(".fasta")).alias("path"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cluster_id, seq_id, seq: a base for each of an embedding's numbers."""
    base = lambda x: F.when(F.abs(x) < 0.01, "N").when(x < -0.085, "A").when(x < 0, "C").when(x < 0.085, "G").otherwise("T")
    e = read(spark, sf_dir, "embeddings")
    seq = F.array_join(F.transform("embedding", lambda x: base(x.cast("double"))), "")
    return e.select(F.col("label").cast("bigint").alias("cluster_id"), F.col("vec_id").alias("seq_id"), seq.alias("seq"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """child, parent of region, nation and customer."""
    region, nation, customer = (read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    r = region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.lit("root").alias("parent"))
    n = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"))
    c = customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("child"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent"))
    return r.unionByName(n).unionByName(c)


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node, start, stop of recombination in nations and regions."""
    region, nation = read(spark, sf_dir, "region"), read(spark, sf_dir, "nation")
    n = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"), (F.col("n_nationkey") * 7 % 50).alias("start"), (F.col("n_nationkey") * 7 % 50 + 5).alias("stop"))
    r = region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"), (F.col("r_regionkey") * 11 % 50).alias("start"), (F.col("r_regionkey") * 11 % 50 + 3).alias("stop"))
    return n.unionByName(r)
