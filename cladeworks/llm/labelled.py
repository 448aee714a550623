"""A bounded sample of labelled documents, never with labels of the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows, and bytes of their texts, that a classifier is fitted on; those with the least hash of their doc_id
#: are taken, as far as the bytes go.
MAX_LABELLED, MAX_BYTES = 16_384, 32 << 20


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; -1 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds, F.lit(-1))


def label_sample(labels: DataFrame, column: str, folds: int, held_out: int, most: int = MAX_LABELLED) -> list[tuple[int, int]]:
    """(doc_id, label) of at most `most` documents outside the held-out fold, in order of the hash of doc_id.

    Labels are 0 or 1; documents with contradictory ones are left out.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & (fold(folds) != held_out))
    one = rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(column).cast("int").alias("label"), F.max(column).alias("most"))
    found = one.filter("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "label").collect()
    return [tuple(r) for r in found]


def labelled_documents(docs: DataFrame, sample: list[tuple[int, int]], most_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, text, label): one row for each document of a sample, as far as most_bytes of texts go.

    Of several rows of a doc_id the least text counts; a null text counts as empty. What is sent to all tasks are at most
    MAX_LABELLED ids; what comes back first is a length for each.
    """
    known = docs.sparkSession.createDataFrame(sample, "doc_id bigint, label int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    size = {r[0]: r[1] for r in rows.select("doc_id", F.octet_length("text").alias("n")).collect()}
    taken, left = [], most_bytes
    for doc_id, label in sample:
        if doc_id in size and size[doc_id] <= left:
            taken.append((doc_id, label))
            left -= size[doc_id]
    picked = docs.sparkSession.createDataFrame(taken, "doc_id bigint, label int")
    return rows.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi").select("doc_id", "text", "label")
