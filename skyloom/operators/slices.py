"""Row-order operators without a single-task window.

A fill, a running total or a numbering needs rows in order, and a window without (or with a
hot) partition key puts all of them into one task. Here the order is cut into slices of like
size, whatever the keys, by Spark's range partitioner, and the cut table is stored. Each slice
is worked on alone and what must cross from one slice to the next is carried by a table with
at most one row per slice.

``order`` must tell rows apart; rows with equal order values share a slice and may change
places.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.functions.values import null_for_nan
from skyloom.session import stored

ROWS_PER_SLICE = 500_000
SLICE = "__slice"


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """Struct that sorts like ``order`` ascending with nulls last."""
    kinds = dict(df.dtypes)
    fields = []
    for i, name in enumerate(order):
        c, kind = F.col(f"`{name}`"), kinds[name]
        if kind == "timestamp":
            c = F.unix_micros(c)
        elif kind == "timestamp_ntz":
            c = F.unix_micros(c.cast("timestamp"))
        elif kind == "date":
            c = F.unix_date(c)
        fields += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*fields)


class Slices:
    """Cuts of a table along an order, made by Spark's range partitioner.

    The number of slices follows the rows (``rows_per_slice``); the partitioner samples the order itself, and the
    table with its slice numbers is stored at once, so every later reading (and a task run again after a lost
    executor) sees the same slices. Nothing of the data enters the plan as a literal.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE):
        self.order = list(order)
        self.key = order_key(df, order)
        rows = df.count()
        self.count = math.ceil(rows / rows_per_slice) if rows else 0

    @property
    def single(self) -> bool:
        return self.count <= 1

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice number: the range partition of the row's order value, in order from 0."""
        if self.single:
            return df.withColumn(SLICE, F.lit(0))
        ranged = df.withColumn("__k", self.key).repartitionByRange(self.count, "__k")
        return stored(ranged.withColumn(SLICE, F.spark_partition_id()).drop("__k"))

    @staticmethod
    def edges(cut: DataFrame, head: Column) -> DataFrame:
        """The first and last value of ``head`` (a prefix of the order) in each slice, without repeats: the only
        values that can lie in more than one slice. At most two rows per slice."""
        ends = cut.groupBy(SLICE).agg(F.min(head).alias("lo"), F.max(head).alias("hi"))
        return ends.select(F.explode(F.array("lo", "hi")).alias("__edge")).distinct()

    def sort(self) -> list[Column]:
        return [F.col(f"`{c}`").asc_nulls_last() for c in self.order]


def _carry_window() -> Window:
    return Window.orderBy(SLICE)


def fill_both_ways(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Give each missing value (null or NaN) the last one before it in order, else the first one after it."""
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in order]
    slices, kinds = Slices(df, order, rows_per_slice), dict(df.dtypes)
    present = {c: null_for_nan(F.col(f"`{c}`")) if kinds[c] in ("double", "float") else F.col(f"`{c}`") for c in columns}
    inside = Window.partitionBy(SLICE).orderBy(*slices.sort())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = {}
    for i, c in enumerate(columns):
        cells[f"__r{i}"] = F.last(present[c], ignorenulls=True).over(upto)
        cells[f"__l{i}"] = F.last(present[c], ignorenulls=True).over(whole)
        cells[f"__f{i}"] = F.first(present[c], ignorenulls=True).over(whole)
    run = slices.assign(df).withColumns(cells)
    # What is still missing after the forward fill precedes every value of its column, so the
    # backward fill gives it the column's very first value.
    if slices.single:
        value = {c: F.coalesce(f"__r{i}", f"__f{i}") for i, c in enumerate(columns)}
    else:
        # One shuffle and one sort of the table; the ends of the slices are read from its result.
        run = stored(run)
        ends = run.groupBy(SLICE).agg(*[F.any_value(f"__{k}{i}").alias(f"{k}{i}") for k in "lf" for i in range(len(columns))])
        earlier = _carry_window().rowsBetween(Window.unboundedPreceding, -1)
        all_slices = _carry_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # One row per slice.
        carried = ends.select(
            SLICE,
            *[F.last(f"l{i}", ignorenulls=True).over(earlier).alias(f"c{i}") for i in range(len(columns))],
            *[F.first(f"f{i}", ignorenulls=True).over(all_slices).alias(f"h{i}") for i in range(len(columns))],
        )
        run = run.join(F.broadcast(carried), SLICE, "left")
        value = {c: F.coalesce(f"__r{i}", f"c{i}", f"h{i}") for i, c in enumerate(columns)}
    return run.select(*[value[c].alias(c) if c in value else F.col(f"`{c}`") for c in df.columns])


def ordinals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number rows within their key from 0, in order. A hot key is spread over many slices."""
    slices = Slices(df, [*keys, *[c for c in order if c not in keys]], rows_per_slice)
    cut = slices.assign(df)
    window = Window.partitionBy(SLICE, *keys).orderBy(*slices.sort())
    local = cut.withColumn(name, F.row_number().over(window) - 1)
    if slices.single:
        return local.drop(SLICE)
    # Only keys found at the ends of a slice lie in more than one slice; there are at most two a slice,
    # and they fill at most two rows per slice below.
    names = [f"__k{i}" for i in range(len(keys))]
    head = order_key(df, keys)
    edge = Slices.edges(cut, head)
    counted = (
        cut.join(F.broadcast(edge), head.eqNullSafe(F.col("__edge")), "left_semi")
        .groupBy(SLICE, *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)])
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    earlier = Window.partitionBy(*names).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offset = counted.withColumn("__offset", F.sum("__n").over(earlier)).drop("__n").withColumnRenamed(SLICE, "__s")
    test = F.col(SLICE) == F.col("__s")
    for k, n in zip(keys, names):
        test = test & F.col(f"`{k}`").eqNullSafe(F.col(n))
    return (
        local.join(F.broadcast(offset), test, "left")
        .withColumn(name, (F.col(name) + F.coalesce("__offset", F.lit(0))).cast("int"))
        .drop(SLICE, "__s", "__offset", *names)
    )


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """For each ``column -> name``, the column's sum over all earlier rows (0 at the start)."""
    slices = Slices(df, order, rows_per_slice)
    cut = slices.assign(df)
    earlier = Window.unboundedPreceding, -1
    sums = cut.groupBy(SLICE).agg(*[F.sum(c).alias(f"__t_{n}") for c, n in totals.items()])
    carried = sums.select(
        SLICE,
        *[
            F.coalesce(F.sum(f"__t_{n}").over(_carry_window().rowsBetween(*earlier)), F.lit(0)).alias(f"__t_{n}")
            for n in totals.values()
        ],
    )
    inside = Window.partitionBy(SLICE).orderBy(*slices.sort()).rowsBetween(*earlier)
    local = cut.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, n in totals.items()})
    # At most one row per slice.
    joined = local.join(F.broadcast(carried), SLICE, "left")
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"__t_{n}")).alias(n) for n in totals.values()]
    )


def positions(df: DataFrame, order: Sequence[str], name: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Position of each row in the whole order, from 0."""
    return running_totals(
        df.withColumn("__one", F.lit(1)), order, {"__one": name}, rows_per_slice
    ).drop("__one")
