"""Flights seen as two rows, one per side, put back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import FLIGHT_KEYS
from skyloom.functions.times import instant
from skyloom.operators.distinct import repeated_keys
from skyloom.operators.shaping import stack
from skyloom.operators.slices import ROWS_PER_SLICE, ordinals
from skyloom.session import stored

ORDINAL = "n_vol"


def _halves(flights: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows seen once and rows of repeated keys, from one counted pass over the table."""
    found = repeated_keys(flights, keys).select(*[F.col(f"`{k}`").alias(f"__{k}") for k in keys], F.lit(True).alias("__repeated"))
    test: Column | None = None
    for k in keys:
        equal = F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`"))
        test = equal if test is None else test & equal
    # Both halves are read from it, the repeated one several times; the join runs once.
    marked = stored(flights.join(found, test, "left").drop(*[f"__{k}" for k in keys]))
    return marked.where("__repeated is null").drop("__repeated"), marked.where("__repeated").drop("__repeated")


def _sides(
    repeated: DataFrame, keys: Sequence[str], dep_order: Sequence[str], arr_order: Sequence[str], rows_per_slice: int
) -> tuple[DataFrame, DataFrame]:
    # Rows with equal times may be numbered either way; the remaining columns settle which.
    rest, kinds = [c for c in repeated.columns if c not in keys], dict(repeated.dtypes)

    def side(kind: str, order: Sequence[str]) -> DataFrame:
        # Text times are ordered by the instant they name, unreadable ones last.
        times = {f"__at_{c}": instant(F.col(f"`{c}`")) for c in order if kinds[c] == "string"}
        first = [f"__at_{c}" if kinds[c] == "string" else c for c in order]
        full = [*first, *[c for c in [*order, *rest] if c not in first and c != "movement_type"]]
        rows = repeated.where(F.col("movement_type") == kind).withColumns(times)
        return ordinals(rows, keys, list(dict.fromkeys(full)), ORDINAL, rows_per_slice).drop(*times)

    return side("departure", dep_order), side("arrival", arr_order)


def _paired(dep: DataFrame, arr: DataFrame, keys: Sequence[str], how: str, sides: tuple[str, str]) -> DataFrame:
    on = [*keys, ORDINAL]
    left = dep.withColumnsRenamed({c: c + sides[0] for c in dep.columns if c not in on})
    right = arr.withColumnsRenamed(
        {c: (f"__{c}" if c in on else c + sides[1]) for c in arr.columns}
    )
    test: Column | None = None
    for k in on:
        equal = F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`"))
        test = equal if test is None else test & equal
    return left.join(right, test, how).drop(*[f"__{k}" for k in on])


def repair_pairs(
    flights: DataFrame,
    keys: Sequence[str] = FLIGHT_KEYS,
    dep_order: Sequence[str] = ("scheduled_departure",),
    arr_order: Sequence[str] = ("scheduled_arrival",),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join the n-th departure row of a repeated flight to its n-th arrival row.

    Paired flights carry every column twice (``_dep``, ``_arr``); a row without partner is
    dropped; flights seen once pass through unchanged.
    """
    keys = list(keys)
    if not {*keys, "movement_type"} <= set(flights.columns):
        return flights
    single, repeated = _halves(flights, keys)
    dep, arr = _sides(repeated, keys, dep_order, arr_order, rows_per_slice)
    return stack(single, _paired(dep, arr, keys, "inner", ("_dep", "_arr")))


def repair_left(
    flights: DataFrame,
    keys: Sequence[str] = FLIGHT_KEYS,
    dep_order: Sequence[str] = ("scheduled_departure", "estimated_departure", "actual_departure"),
    arr_order: Sequence[str] = ("scheduled_arrival", "estimated_arrival", "actual_arrival"),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """As ``repair_pairs``, but a departure without partner stays and columns are not doubled:

    each takes the departure side's value, else the arrival side's.
    """
    keys = list(keys)
    single, repeated = _halves(flights, keys)
    dep, arr = _sides(
        repeated, keys,
        [c for c in dep_order if c in flights.columns], [c for c in arr_order if c in flights.columns],
        rows_per_slice,
    )
    paired = _paired(dep, arr, keys, "left", ("__d", "__a"))
    merged = paired.select(
        *[
            F.col(f"`{c}`") if c in keys else F.coalesce(f"{c}__d", f"{c}__a").alias(c)
            for c in flights.columns
        ]
    )
    return stack(single, merged)
