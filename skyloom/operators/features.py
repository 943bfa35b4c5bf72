"""Model inputs: date parts, category codes, medians, exact seeded splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from skyloom.constants import ESTIMATE_COLUMNS, FEATURE_DATE_COLUMNS, FLIGHT_KEYS, LATE_AFTER_MINUTES, LEAKAGE_COLUMNS
from skyloom.functions.times import wall_clock
from skyloom.functions.values import late_label
from skyloom.operators.distinct import keep_unique
from skyloom.operators.lookup import MAX_BYTES, MAX_ROWS, attach, measure, sized
from skyloom.operators.profile import purge
from skyloom.operators.slices import ROWS_PER_SLICE, ordinals
from skyloom.session import settle, stored

TARGET = "retard_arrivee"
MISSING_CATEGORY = "nan"
UNSEEN = -1


def _clock(df: DataFrame, name: str) -> Column:
    """A column as local wall clock, whether it holds text, a date or a time."""
    kind, c = dict(df.dtypes)[name], F.col(f"`{name}`")
    if kind == "string":
        return F.coalesce(wall_clock(c), F.substring(c, 1, 10).try_cast("timestamp_ntz"))
    return c


def date_parts(
    df: DataFrame,
    day: str = "flight_date",
    departure: str = "scheduled_departure_dep",
    arrival: str = "scheduled_arrival_arr",
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Month, day, weekday (Monday 0) of the flight, hour and minute of both schedules.

    Columns that are absent give no parts. The sources are dropped.
    """
    parts = {}
    if day in df.columns:
        d = _clock(df, day)
        parts |= {"flight_month": F.month(d), "flight_day": F.dayofmonth(d), "flight_dayofweek": F.weekday(d)}
    for name, prefix in ((departure, "sched_dep"), (arrival, "sched_arr")):
        if name in df.columns:
            t = _clock(df, name)
            parts |= {f"{prefix}_hour": F.hour(t), f"{prefix}_minute": F.minute(t)}
    return df.withColumns(parts).drop(*(drop if drop is not None else [day, departure, arrival]))


def date_parts_wide(
    df: DataFrame, columns: Sequence[str] = ("flight_date", "scheduled_departure", "scheduled_arrival")
) -> DataFrame:
    """``<column>_month``, ``_weekday`` and ``_hour`` beside each date column."""
    parts = {}
    for name in columns:
        if name in df.columns:
            t = _clock(df, name)
            parts |= {f"{name}_month": F.month(t), f"{name}_weekday": F.weekday(t), f"{name}_hour": F.hour(t)}
    return df.withColumns(parts)


def training_table(
    flights: DataFrame,
    order: Sequence[str] = FLIGHT_KEYS,
    late_after: float = LATE_AFTER_MINUTES,
    extra_keep: Sequence[str] = (),
    fill_target: bool = True,
) -> DataFrame:
    """Flights seen once, purged and filled, with the late label; the older label is dropped."""
    # Read by the null shares, the slice limits and the fill; the shuffle behind it runs once.
    unique = stored(keep_unique(flights, list(FLIGHT_KEYS)))
    clean = purge(unique, order, extra_keep=extra_keep, fill_target=fill_target)
    return clean.withColumn(TARGET, late_label(F.col("arrival_delay_min"), late_after)).drop("retard arrivée")


def drop_leakage(df: DataFrame, target: str, estimates: bool = False) -> DataFrame:
    """Drop columns that give the target away; ``estimates`` drops all times known after departure too."""
    leak = [*LEAKAGE_COLUMNS, TARGET, *(ESTIMATE_COLUMNS if estimates else ())]
    return df.drop(*[c for c in leak if c != target])


def model_input(table: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows with a target (neither null nor NaN); leakage columns out, date parts in."""
    goal = F.col(f"`{target}`")
    known = table.where(goal.isNotNull() & ~F.isnan(goal.cast("double")))
    return date_parts(drop_leakage(known, target), drop=FEATURE_DATE_COLUMNS)


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, k in df.dtypes if k == "string"]


def number_columns(df: DataFrame) -> list[str]:
    """Numbers, decimals and booleans; booleans count as 0 and 1."""
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")
    return [n for n, k in df.dtypes if k in kinds or k.startswith("decimal")]


def refuse_other_columns(df: DataFrame) -> None:
    """A column that is neither text nor number must be turned into one, or left out, by the caller."""
    other = sorted(set(df.columns) - set(text_columns(df)) - set(number_columns(df)))
    if other:
        raise ValueError(f"columns that are neither text nor number: {', '.join(other)}")


# Category codes ----------------------------------------------------------------------------


def _category(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING_CATEGORY))


def fit_codes(df: DataFrame, columns: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``column, value, code`` for all columns in one pass; codes follow the sorted values."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), _category(F.col(f"`{c}`")).alias("value")) for c in columns]
    )
    values = df.select(F.explode(cells).alias("cell")).select("cell.*").distinct()
    return ordinals(settle(values), ["column"], ["value"], "code", rows_per_slice)


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their code; a category without code becomes -1."""
    kept = settle(codes)
    rows, size = measure(kept)
    small = rows <= MAX_ROWS and size <= MAX_BYTES
    out = df
    for c in columns:
        mine = kept.where(F.col("column") == c).select("value", "code")
        keyed = out.withColumn("__value", _category(F.col(f"`{c}`")))
        joined = attach(keyed, F.broadcast(mine) if small else mine, {"__value": "value"})
        out = joined.withColumn(c, F.coalesce("code", F.lit(UNSEEN)).cast("double")).drop("__value", "code")
    return out.select(*df.columns)


def one_hot(columns: Sequence[str], suffix: str = "_hot") -> Pipeline:
    """Stages for a 0/1 vector per category; missing reads "Unknown", unseen gives all zeros."""
    indexed = [f"{c}_index" for c in columns]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(columns), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(
                inputCols=indexed, outputCols=[c + suffix for c in columns], handleInvalid="error", dropLast=True
            ),
        ]
    )


def unknown_for_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna("Unknown", subset=list(columns))


# Medians -----------------------------------------------------------------------------------

EXACT_ROWS = 1_000_000
ACCURACY = 100_000


def medians(df: DataFrame, columns: Sequence[str], exact_rows: int = EXACT_ROWS) -> DataFrame:
    """One row with the exact median of each column (missing values left out).

    Brackets around the middle are narrowed with approximate percentiles until few rows lie
    inside; values outside are moved to the bracket's ends, which keeps the median and leaves
    the exact aggregate little to hold.
    """
    names = list(columns)
    value = {c: _number(df, c) for c in names}
    first = df.agg(*[F.count(value[c]).alias(c) for c in names]).first()
    total = {c: first[c] for c in names}
    low: dict[str, float | None] = dict.fromkeys(names)
    high: dict[str, float | None] = dict.fromkeys(names)
    below = dict.fromkeys(names, 0)
    inside = dict(total)
    open_columns = [c for c in names if inside[c] > exact_rows]
    while open_columns:
        parts = []
        for c in open_columns:
            slack = 2 * inside[c] // ACCURACY + 1
            start = max(0.0, ((total[c] - 1) // 2 - below[c] - slack) / inside[c])
            end = min(1.0, (total[c] // 2 - below[c] + slack + 1) / inside[c])
            parts.append(
                F.percentile_approx(_within(value[c], low[c], high[c]), [start, end], ACCURACY).alias(c)
            )
        limits = df.agg(*parts).first()
        before = {c: (low[c], high[c]) for c in open_columns}
        for c in open_columns:
            low[c], high[c] = float(limits[c][0]), float(limits[c][1])
        found = df.agg(
            *[F.count_if(value[c] < low[c]).alias(f"b_{c}") for c in open_columns],
            *[F.count(_within(value[c], low[c], high[c])).alias(f"i_{c}") for c in open_columns],
        ).first()
        for c in open_columns:
            below[c], inside[c] = found[f"b_{c}"], found[f"i_{c}"]
        open_columns = [
            c for c in open_columns
            if inside[c] > exact_rows and low[c] != high[c] and (low[c], high[c]) != before[c]
        ]
    return df.agg(*[F.median(_clamped(value[c], low[c], high[c])).alias(c) for c in names])


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(c), c)


def _within(c: Column, low: float | None, high: float | None) -> Column:
    return c if low is None else F.when(c.between(low, high), c)


def _clamped(c: Column, low: float | None, high: float | None) -> Column:
    return c if low is None else F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def impute(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Fill missing numbers with the fitted values."""
    return df.withColumns(
        {
            c: F.coalesce(_number(df, c), F.lit(v).cast("double"))
            for c, v in values.items()
            if c in df.columns and v is not None
        }
    )


def align(df: DataFrame, layout: StructType, missing: float | None = 0.0) -> DataFrame:
    """Training columns in training order; absent ones hold ``missing``."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(missing)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
    )


# Splits ------------------------------------------------------------------------------------


def seeded_hash(keys: Sequence[str], seed: int) -> Column:
    """Text that orders rows at random but always the same way."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))


PREFIX = 4
EXACT_CELL = 200_000


def _placed(cells: DataFrame) -> DataFrame:
    """The cell of hash values (stratum, cut, prefix, n) in which each cut's target lies, with the rows before it."""
    upto = Window.partitionBy("stratum", "cut").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
    return counted.where("target > before and target <= before + n")


def _in_cells(hashed: DataFrame, edge: DataFrame, length: int) -> DataFrame:
    """Hashes of the cells that hold a cut; a null stratum is a stratum."""
    named = edge.withColumnsRenamed({"stratum": "__stratum", "prefix": "__prefix", "n": "__n"})
    test = F.col("stratum").eqNullSafe(F.col("__stratum")) & (F.substring("h", 1, length) == F.col("__prefix"))
    return hashed.join(named, test).drop("__stratum", "__prefix", "__n")


def hash_cuts(
    df: DataFrame, keys: Sequence[str], shares: Sequence[float], seed: int, by: str | None = None, exact_cell: int = EXACT_CELL
) -> DataFrame:
    """Per stratum, the hash values that end the first ``ceil(share * rows)`` rows.

    A histogram of hash prefixes (at most 65,536 per stratum and cut) finds the prefix in which each
    cut falls; while such a prefix holds more than ``exact_cell`` rows, a longer one is looked for within it. Only the rows
    of the last prefixes are ranked. The table itself is not sorted and not moved.
    """
    stratum = F.lit(0) if by is None else F.col(f"`{by}`")
    hashed = df.select(stratum.alias("stratum"), seeded_hash(keys, seed).alias("h"))
    histogram = hashed.groupBy("stratum", F.substring("h", 1, PREFIX).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)])
    cells = (
        histogram.withColumn("rows", F.sum("n").over(Window.partitionBy("stratum")))
        .withColumn("w", F.explode(wanted))
        .select(
            "stratum", "prefix", "n", "w.cut", F.lit(0).cast("long").alias("before"),
            F.ceil(F.bround(F.col("w.share") * F.col("rows"), 6)).alias("target"),
        )
    )
    # One row per stratum and cut.
    edge, length = sized(_placed(cells)), PREFIX
    while length < 32 and (edge.agg(F.max("n")).first()[0] or 0) > exact_cell:
        length += PREFIX
        inner = _in_cells(hashed, edge, length - PREFIX).groupBy(
            "stratum", "cut", "before", "target", F.substring("h", 1, length).alias("prefix")
        ).agg(F.count(F.lit(1)).alias("n"))
        edge = sized(_placed(inner))
    # Copies of a key share their hash and count as one entry, so they never pile up in a window.
    inside = _in_cells(hashed, edge, length).groupBy("stratum", "cut", "h", "before", "target").agg(F.count(F.lit(1)).alias("n"))
    upto_here = Window.partitionBy("stratum", "cut").orderBy("h")
    return (
        inside.withColumn("place", F.sum("n").over(upto_here) + F.col("before"))
        .where("place >= target")
        .groupBy("stratum", "cut")
        .agg(F.min("h").alias("h"))
        .groupBy("stratum")
        .agg(F.array_sort(F.collect_list("h")).alias("cuts"))
    )


def assign_parts(
    df: DataFrame, keys: Sequence[str], shares: Sequence[float], seed: int = 42, by: str | None = None, name: str = "part",
    exact_cell: int = EXACT_CELL,
) -> DataFrame:
    """Number the part of each row: 0 up to the first cut, and so on.

    Rows with equal ``keys`` stay together; with unique keys the parts have their exact sizes.
    """
    # One row per stratum.
    cuts = sized(hash_cuts(df, keys, shares, seed, by, exact_cell))
    stratum = F.lit(0) if by is None else F.col(f"`{by}`")
    keyed = df.withColumn("__stratum", stratum).withColumn("__h", seeded_hash(keys, seed))
    joined = attach(keyed, cuts, {"__stratum": "stratum"}, null_keys_match=True)
    part = F.size(F.filter("cuts", lambda cut: cut < F.col("__h")))
    return joined.withColumn(name, part).drop("__stratum", "__h", "cuts")


def split(
    df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, by: str | None = None, exact_cell: int = EXACT_CELL
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; each stratum gives ``ceil(test_share * rows)`` rows to the test."""
    parts = assign_parts(df, keys, [test_share], seed, by, "__part", exact_cell)
    return parts.where("__part = 1").drop("__part"), parts.where("__part = 0").drop("__part")


def folds(df: DataFrame, keys: Sequence[str], count: int = 5, seed: int = 42, by: str | None = None) -> DataFrame:
    """Add a ``fold`` column with folds of equal size in each stratum."""
    return assign_parts(df, keys, [i / count for i in range(1, count)], seed, by, "fold")


def seeded_sample(df: DataFrame, keys: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    """``rows`` rows picked by hash; each input partition keeps only its own best ``rows``."""
    return df.withColumn("__h", seeded_hash(keys, seed)).orderBy("__h", *keys).limit(rows).drop("__h")
