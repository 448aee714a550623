"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans.shared import dealt, give_back, ship

#: Rows and bytes of one Arrow batch that the JVM sends, and bytes that a Python stage works on at once: its arrays take
#: many times the bytes of their texts. One text may be longer than this; it is then worked on alone.
BATCH_ROWS, BATCH_BYTES, SLICE_BYTES = 20_000, 2 << 20, 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, holds: tuple | None = None) -> DataFrame:
    """df.mapInArrow in workers that hold little: small batches, no objects of other stages, freed memory given back.

    holds: the key of the worker_cache entry that this stage uses; a worker forgets all others when the stage begins.
    """
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def lean(batches):
        forget_all_but(holds)
        try:
            yield from run(slices(batches))
        finally:
            give_back()

    return df.mapInArrow(lean, schema)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about SLICE_BYTES."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Deal a small table out to all cores.
spread = dealt


def forget_all_but(key: tuple | None) -> None:
    """Drop what earlier stages left in this worker."""
    if key not in _CACHE:
        _CACHE.clear()
    give_back()


def worker_cache(key: tuple, build):
    """One object per Python worker process (tokenizer tables, compiled automata)."""
    found = _CACHE.get(key)
    if found is None:
        _CACHE.clear()
        found = _CACHE[key] = build()
    return found


_CACHE: dict = {}
