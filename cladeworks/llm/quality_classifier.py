"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

`fit_quality` trains on a bounded sample of labelled documents (labelled.MAX_LABELLED rows, never the held-out
fold), whose statistics are computed where the texts are; only statistics and labels reach the driver. `score`
steps all trees down their flattened arrays, one numpy operation a level.

Edge cases: a null text counts as empty and is scored like any other; without labels of both kinds every score is
the prior; repeated rows get equal scores; `score` and `predicted` in the input are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbt
from .bpe_codec import mapped
from .common import in_arrow, spread, table
from .labelled import MAX_LABELLED, fold, label_sample, labelled_documents
from .text_statistics import NAMES, statistics

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5


def fit_quality(docs: DataFrame, labels: DataFrame, column: str = "quality", most: int = MAX_LABELLED) -> gbt.Trees:
    """Trees fitted on labelled documents outside the held-out fold."""
    sample = label_sample(labels, column, FOLDS, HELD_OUT, most)

    def run(batches):
        for batch in batches:
            x = statistics(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2)], ["doc_id", "x", "label"])

    rows = in_arrow(labelled_documents(spread(docs), sample), run, "doc_id bigint, x array<double>, label int").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(NAMES))
    return gbt.fit(x, np.array([r["label"] for r in rows], float))


def score(docs: DataFrame, trees: gbt.Trees, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs plus `score` (probability of label 1) and `predicted`; one narrow stage."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def make(texts):
        p = sent.value.probability(statistics(texts))
        return p, (p >= threshold).astype(np.int32)

    return mapped(docs, text, [("score", "double", pa.float64()), ("predicted", "int", pa.int32())], make)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score(spread(docs), trees).drop("text")
    return scored.withColumn("held_out", fold(FOLDS) == HELD_OUT).select("doc_id", "held_out", "score", "predicted")
