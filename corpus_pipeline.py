"""Training-corpus pipeline: five stages over `documents`, each calling one operator of cladeworks.llm.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of documents. Null texts count as empty; the quality
stage judges them like any other row. Columns of the input named like an operator's are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm import bpe_codec, decontaminate, near_duplicates, personal_data, quality_classifier
from cladeworks.llm.common import spread, table
from cladeworks.llm.vocabularies import path
from cladeworks.plans.shared import kept


def _guarded(docs: DataFrame, names: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage(docs) while columns of docs with an operator's names are set aside."""
    clash = [c for c in docs.columns if c in names]
    for c in clash:
        docs = docs.withColumnRenamed(c, f"__kept_{c}")
    out = stage(docs)
    for c in clash:
        out = out.drop(c).withColumnRenamed(f"__kept_{c}", c)
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    trees = quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels"))
    judged = lambda d: quality_classifier.score(spread(d), trees).filter("predicted = 1")
    return _guarded(docs, ("score", "predicted"), judged).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return _guarded(docs, ("class_id",), near_duplicates.keep_one).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents with words inside a benchmark window."""
    clean = lambda d: decontaminate.decontaminate(spread(d), table(spark, sf_dir, "benchmark")).filter("n_hit = 0")
    return _guarded(docs, ("n_words", "n_hit", "items", "matches"), clean).select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the text."""
    out = personal_data.redact(spread(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32-bit) of every text, and whether they decode to it."""
    tokenizer = path("byte_bpe_50k.json")

    def codes(d):
        coded = bpe_codec.there_and_back(spread(d), tokenizer)
        return coded.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")

    return codes(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", redaction),
    ("tokens", tokens),
]

#: SQL can express neither the trees nor the signatures; tests/llm/test_pipeline.py holds each stage against a plain program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
