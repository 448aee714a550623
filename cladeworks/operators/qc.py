"""Quality gates on samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def size_check(files: DataFrame, size: Column, least: int, step: str = "Minimum file size", sample: str = "sample") -> DataFrame:
    """(sample, qc_step, outcome): PASS from `least` bytes on."""
    return files.select(F.col(sample), F.lit(step).alias("qc_step"), F.when(size >= least, "PASS").otherwise("FAIL").alias("outcome"))


def gate(payload: DataFrame, checks: DataFrame, sample: str = "sample") -> DataFrame:
    """The rows whose sample has no failed check; samples without checks pass."""
    return payload.join(checks.filter(F.contains("outcome", F.lit("FAIL"))).select(sample).distinct(), sample, "left_anti")


def largest(files: DataFrame, name: str, size: str) -> DataFrame:
    """One row: the largest file, the least name among equals."""
    return files.agg(F.min_by(name, F.struct(-F.col(size), F.col(name))).alias(name), F.max(size).alias(size))


def duplicates(samples: DataFrame, sample: str = "sample") -> DataFrame:
    """Samples that are listed more than once."""
    return samples.groupBy(sample).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(samples: DataFrame, sample: str = "sample") -> DataFrame:
    """samples, or an error that names a repeated one."""
    if found := duplicates(samples, sample).limit(5).collect():
        raise ValueError("repeated samples: " + ", ".join(str(r[sample]) for r in found))
    return samples


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df


def without_reference(files: DataFrame, reference: DataFrame, name: str) -> DataFrame:
    return files.join(reference.select(name), name, "left_anti")
