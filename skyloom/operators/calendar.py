"""Day table: weekends, public holidays and school holidays, and its join to flights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.constants import CALENDAR_CITIES, SCHOOL_PERIODS, SCHOOL_ZONES, SUMMER_LABEL
from skyloom.functions.text import sorted_distinct
from skyloom.functions.times import days, public_holiday, weekend
from skyloom.operators.lookup import attach, sized

CALENDAR_COLUMNS = [
    "date",
    "Vacances Scolaires",
    "Label des Vacances",
    "Jour férié",
    "Label Jour Ferié",
    "Week End",
    *CALENDAR_CITIES.values(),
]


def day_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """All days of a range, both ends included."""
    return spark.range(1).select(
        F.explode(days(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("date")
    )


def school_periods(spark: SparkSession) -> DataFrame:
    """The known school holidays as a table ``city, label, start_date, end_date``."""
    rows = [
        (city, label, first, last)
        for city, zone in SCHOOL_ZONES.items()
        for label, first, last in SCHOOL_PERIODS[zone]
    ]
    return spark.createDataFrame(rows, "city string, label string, start_date date, end_date date")


def school_days(periods: DataFrame, cities: Iterable[str] = CALENDAR_CITIES) -> DataFrame:
    """One row per holiday day with each city's label; the later of two overlapping periods holds.

    Periods are unrolled to days, so day lookups are equi-joins and not range conditions.
    """
    by_day = periods.select(
        "city", "label", "start_date", F.explode(days(F.col("start_date"), F.col("end_date"))).alias("date")
    )
    return by_day.groupBy("date").agg(
        *[
            F.max_by("label", F.when(F.col("city") == city, F.col("start_date"))).alias(f"label_{city}")
            for city in cities
        ]
    )


def calendar(spine: DataFrame, periods: DataFrame | None = None, holiday_years: Iterable[int] | None = None) -> DataFrame:
    """Calendar of the days in ``spine`` (one ``date`` per row).

    Public holidays are those of each date's own year; ``holiday_years`` limits them.
    """
    periods = school_periods(spine.sparkSession) if periods is None else periods
    joined = attach(spine, sized(school_days(periods)), {"date": "date"})
    holiday = public_holiday(F.col("date"))
    if holiday_years is not None:
        holiday = F.when(F.year("date").isin(*holiday_years), holiday)
    labels = [F.col(f"label_{city}") for city in CALENDAR_CITIES]
    off = F.array_compact(F.array(*[F.when(l.isNotNull(), c) for c, l in zip(CALENDAR_CITIES, labels)]))
    names = sorted_distinct(F.array_compact(F.array(*labels)))
    return joined.select(
        "date",
        F.array_join(off, ", ").alias("Vacances Scolaires"),
        F.array_join(names, ", ").alias("Label des Vacances"),
        holiday.isNotNull().cast("int").alias("Jour férié"),
        F.coalesce(holiday, F.lit("")).alias("Label Jour Ferié"),
        weekend(F.col("date")).alias("Week End"),
        *[l.isNotNull().cast("int").alias(column) for column, l in zip(CALENDAR_CITIES.values(), labels)],
    )


def summer(label: Column) -> Column:
    """1 for a day whose only label is the summer holiday; combined labels do not count."""
    return F.coalesce(label == SUMMER_LABEL, F.lit(False)).cast("int")


def add_calendar(flights: DataFrame, table: DataFrame, day: str = "flight_date") -> DataFrame:
    """Left join the calendar on the flight's day and add ``is_summer_vacation``."""
    keyed = flights.withColumn("__day", F.trim(F.col(day).cast("string")).try_cast("date"))
    joined = attach(keyed, sized(table), {"__day": "date"}).drop("__day")
    return joined.withColumn("is_summer_vacation", summer(F.col("Label des Vacances")))


def calendar_for(flights: DataFrame, day: str = "flight_date", periods: DataFrame | None = None) -> DataFrame:
    """Calendar of the days that occur in a flight table."""
    seen = flights.select(F.trim(F.col(day).cast("string")).try_cast("date").alias("date")).where("date is not null")
    return calendar(seen.distinct(), periods)
