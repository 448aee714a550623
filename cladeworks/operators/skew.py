"""Joins in which a key may have very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one in SHARE of all rows, so fewer than SHARE keys are; below LEAST rows none is.
SHARE, LEAST, SALTS = 500, 200, 32
#: Rows that one task may hold in any case: joins of fewer are not split.
FEW = 20_000


def hot_rows(total: int) -> int:
    """The rows that a key needs to be hot."""
    return max(LEAST, total // SHARE)


def split_join(left: DataFrame, right: DataFrame, key: str, by: str | Column, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """left join right on key; hot keys of left are split into SALTS parts by `by`, their rows of right repeated for each.

    Keys are counted in `counted`, a written table with left's keys; if there is none in left itself, which should be one.
    What is broadcast are keys, fewer than SHARE of them.
    """
    counted = left if counted is None else counted
    if (total := counted.count()) <= FEW:
        return left.join(right, key, how)
    least = hot_rows(total)
    hot = counted.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > least).select(key, F.lit(True).alias("__hot"))
    hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    salted = left.join(hot, key, "left").withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0))).drop("__hot")
    every = F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    repeated = right.join(hot, key, "left").withColumn("__salt", every).drop("__hot")
    return salted.join(repeated, [key, "__salt"], how).drop("__salt")
