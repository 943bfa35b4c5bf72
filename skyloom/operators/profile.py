"""Profiles of a table; each is one aggregate over all columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import PLACEHOLDERS, PROTECTED_WORDS
from skyloom.operators.shaping import kept_by_name
from skyloom.operators.slices import ROWS_PER_SLICE, fill_both_ways

FLOATS = ("double", "float")


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[name] in FLOATS else c.isNull()


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: the percentage of missing values of each column."""
    return df.agg(*[(F.avg(_missing(df, c).cast("int")) * 100).alias(c) for c in df.columns])


def null_profile(df: DataFrame, top: int = 30) -> DataFrame:
    """Columns with missing values, worst first."""
    long = null_percentages(df).unpivot([], df.columns, "colonne", "pct_missing")
    return long.where("pct_missing > 0").orderBy(F.desc("pct_missing"), "colonne").limit(top)


def emptiness(df: DataFrame, words: Iterable[str] = PLACEHOLDERS) -> DataFrame:
    """Cells that are missing, empty text, a placeholder word, or infinite.

    A missing cell also reads as the word "nan" in text form and counts there too.
    """
    words, kinds = list(words), dict(df.dtypes)
    nulls, empties, placeholders, infinite = [], [], [], []
    for name, kind in kinds.items():
        c = F.col(f"`{name}`")
        missing = _missing(df, name)
        nulls.append(F.count_if(missing))
        if kind == "string":
            empties.append(F.count_if(c == ""))
            placeholders.append(F.count_if(missing | F.lower(c).isin(*words)))
        else:
            placeholders.append(F.count_if(missing))
        if kind in FLOATS:
            infinite.append(F.count_if(F.abs(c) == float("inf")))

    def total(parts: list[Column]) -> Column:
        out = F.lit(0).cast("bigint")
        for p in parts:
            out = out + p
        return out

    return df.agg(
        total(nulls).alias("nulls"),
        total(empties).alias("empty_texts"),
        total(placeholders).alias("placeholder_words"),
        total(infinite).alias("infinite_values"),
    )


def health(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells."""
    missing = F.lit(0).cast("bigint")
    for c in df.columns:
        missing = missing + F.count_if(_missing(df, c))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        missing.alias("n_missing"),
    )


def sparse_columns(df: DataFrame, limit: float, protected: Iterable[str] = ()) -> list[str]:
    """Names of columns missing in more than ``limit`` (0..1) of the rows; one row is collected."""
    shares = null_percentages(df).first()
    protected = list(protected)
    return [
        c
        for c in df.columns
        if shares[c] is not None and shares[c] > 100 * limit and not any(w in c.lower() for w in protected)
    ]


def drop_sparse(df: DataFrame, limit: float = 0.65, protected: Iterable[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, limit, protected))


def purge(
    df: DataFrame,
    order: Sequence[str],
    limit: float = 0.6,
    extra_keep: Iterable[str] = (),
    fill: bool = True,
    fill_target: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Keep columns by name, drop sparse ones unless protected, fill the rest both ways.

    ``fill_target=False`` leaves the delay columns as they are, so that no flight takes a
    neighbour's delay.
    """
    named = df.select(*[F.col(f"`{c}`") for c in kept_by_name(df.columns, extra_keep)])
    dense = drop_sparse(named, limit, PROTECTED_WORDS)
    if not fill:
        return dense
    targets = [] if fill_target else [c for c in dense.columns if any(w in c.lower() for w in PROTECTED_WORDS)]
    # Order columns may have been purged; they come along for the fill only.
    extra = [c for c in order if c not in dense.columns]
    wide = df.select(*[F.col(f"`{c}`") for c in [*dense.columns, *extra]])
    fillable = [c for c in dense.columns if c not in targets]
    return fill_both_ways(wide, order, fillable, rows_per_slice).drop(*extra)
