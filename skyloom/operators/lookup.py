"""Joins to lookup tables, broadcast only when the table has been measured.

A hint-free join would shuffle the large side before the small side's size is known; a bare
broadcast hint fails when the "small" side has grown. Here the lookup side is computed once,
stored and measured, and only then is the strategy chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.session import settle

MAX_ROWS = 2_000_000
MAX_BYTES = 128 * 1024 * 1024


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of a table, and roughly its bytes when its values are written as text."""
    width = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string" or kind.startswith(("array", "struct", "map", "binary")):
            text = F.col(f"`{name}`") if kind == "string" else F.to_json(F.struct(F.col(f"`{name}`")))
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"], row["b"] or 0


def sized(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` stored once; marked for broadcast when it is within both bounds.

    Beyond them it is returned unmarked: the join then shuffles both sides and Spark splits
    the partitions of hot keys at run time.
    """
    kept = settle(df)
    rows, size = measure(kept)
    return F.broadcast(kept) if rows <= max_rows and size <= max_bytes else kept


def attach(left: DataFrame, right: DataFrame, on: dict[str, str], null_keys_match: bool = False) -> DataFrame:
    """Left join by pairs of names (left name -> right name); the right-hand keys are dropped.

    ``right`` must hold one row per key, so the left row count never changes.
    """
    renamed = {r: f"__key_{i}" for i, r in enumerate(on.values())}
    right = right.withColumnsRenamed(renamed)
    test: Column | None = None
    for l, r in on.items():
        a, b = F.col(f"`{l}`"), F.col(renamed[r])
        equal = a.eqNullSafe(b) if null_keys_match else a == b
        test = equal if test is None else test & equal
    return left.join(right, test, "left").drop(*renamed.values())
