"""Repeated keys: keep the first row, keep none, report them.

None of these gathers a key's rows in one task: copies are cut down inside each input
partition first, so a key that holds a large part of the table costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in ``order``; null keys form a key of their own.

    The rank filter is applied by each input partition before the shuffle (partial window
    group limit), which leaves at most one row per key and partition to move.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the rows whose key occurs once.

    Two rows of a key are enough to know that it is repeated, and each input partition passes
    on no more than two (partial window group limit).
    """
    same_key = Window.partitionBy(*keys)
    two = df.withColumn("__rank", F.row_number().over(same_key.orderBy(*keys))).where("__rank <= 2")
    return two.withColumn("__n", F.count(F.lit(1)).over(same_key)).where("__n = 1").drop("__rank", "__n")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial counts before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def repeated_rows(df: DataFrame, keys: Sequence[str], present: bool = True) -> DataFrame:
    """All rows whose key is repeated (or, with ``present=False``, all others)."""
    found = repeated_keys(df, keys).select(*[F.col(f"`{k}`").alias(f"__{k}") for k in keys])
    test = None
    for k in keys:
        equal = F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`"))
        test = equal if test is None else test & equal
    return df.join(found, test, "left_semi" if present else "left_anti")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
