"""Airport traffic per day: counts, deviation from the airport's mean, and lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.constants import CONGESTION_OVER_PERCENT
from skyloom.functions.text import joined
from skyloom.functions.values import over, percent_deviation
from skyloom.operators.distinct import keep_first
from skyloom.operators.lookup import attach, sized
from skyloom.operators.movements import domestic_route, served_route, target_route, valid_movement
from skyloom.operators.slices import positions
from skyloom.session import stored

SCOPES: dict[str, Callable[[Column, Column], Column]] = {
    "cible": target_route,
    "france": domestic_route,
    "ww": served_route,
}
MEASURES = ["nombre_departs", "nombre_arrivees", "somme_depart_arrivee", "congestion"]


def own_side(movements: DataFrame, *more: str) -> DataFrame:
    """Valid movements with the day and airport they count for."""
    departing = F.col("movement_type") == "departure"
    return movements.where(valid_movement()).select(
        F.col("movement_date").alias("flight_date"),
        F.when(departing, F.col("airport_origin")).otherwise(F.col("airport_destination")).alias("airport"),
        departing.alias("departing"),
        "airport_origin",
        "airport_destination",
        *more,
    )


def counts(movements: DataFrame, scope: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Departures and arrivals per day and airport, 0 where there are none."""
    rows = own_side(movements)
    if scope is not None:
        rows = rows.where(scope(F.col("airport_origin"), F.col("airport_destination")))
    return rows.groupBy("flight_date", "airport").agg(
        F.count_if(F.col("departing")).cast("int").alias("nombre_departs"),
        F.count_if(~F.col("departing")).cast("int").alias("nombre_arrivees"),
    )


def counts_by_scope(movements: DataFrame, scopes: Mapping[str, Callable] = SCOPES) -> DataFrame:
    """The counts of several route scopes from one pass over the movements."""
    inside = {
        name: test(F.col("airport_origin"), F.col("airport_destination")) for name, test in scopes.items()
    }
    aggregates = []
    for name, test in inside.items():
        aggregates += [
            F.count_if(test & F.col("departing")).cast("int").alias(f"departs_{name}"),
            F.count_if(test & ~F.col("departing")).cast("int").alias(f"arrivees_{name}"),
        ]
    wide = own_side(movements).groupBy("flight_date", "airport").agg(*aggregates)
    long = wide.select(
        "flight_date",
        "airport",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("scope"),
                        F.col(f"departs_{n}").alias("nombre_departs"),
                        F.col(f"arrivees_{n}").alias("nombre_arrivees"),
                    )
                    for n in inside
                ]
            )
        ).alias("s"),
    ).select("s.scope", "flight_date", "airport", "s.nombre_departs", "s.nombre_arrivees")
    return long.where("nombre_departs + nombre_arrivees > 0")


def daily_counts(movements: DataFrame) -> DataFrame:
    """Counts per day and airport with their sum (the single-day form)."""
    return counts(movements).withColumn(
        "somme_depart_arrivee", F.col("nombre_departs") + F.col("nombre_arrivees")
    )


def reply_table(records: DataFrame, request: str) -> DataFrame:
    """Matched records of requests with principal and codeshare numbers as text and, for the
    first record's airport of origin, the arrivals and departures among the request's records. Records without a
    departure time come last.

    Totals are joined back from an aggregate, so a request with many records is not gathered.
    """
    first = records.groupBy(request).agg(F.min(F.struct(F.col("scheduled_departure").isNull().alias("untimed"), "scheduled_departure", "airport_origin")).alias("f"))
    home = first.select(request, F.col("f.airport_origin").alias("home"))
    per_airport = own_side(records.withColumn("request", F.col(request)), "request").groupBy("request", "airport").agg(
        F.count_if(~F.col("departing")).alias("total_global_arrivals_at_airport"),
        F.count_if(F.col("departing")).alias("total_global_departures_from_airport"),
    )
    totals = attach(home, per_airport, {request: "request", "home": "airport"}).fillna(0).drop("home")
    named = records.withColumns(
        {"flight_number_principal": F.col("flight_number"), "flight_number_codeshare": joined(F.col("codeshares"))}
    )
    return attach(named, totals.withColumnRenamed(request, "__request"), {request: "__request"})


def trim_ends(df: DataFrame, order: list[str], head: int = 3, tail: int = 1) -> DataFrame:
    """Drop the first ``head`` and last ``tail`` rows in order."""
    # Counted, cut into slices and summed; what lies behind it runs once.
    df = stored(df)
    rows = df.count()
    placed = positions(df, order, "__position")
    return placed.where((F.col("__position") >= head) & (F.col("__position") < rows - tail)).drop("__position")


def flagged(
    counted: DataFrame, threshold: float = CONGESTION_OVER_PERCENT, airport: str = "airport"
) -> DataFrame:
    """Add the sum, its deviation from the airport's mean in percent and the congestion flag.

    ``counted`` holds one row per day and airport, so a window partition has one row per day.
    """
    total = F.coalesce(F.col("nombre_departs"), F.lit(0)) + F.coalesce(F.col("nombre_arrivees"), F.lit(0))
    mean = F.avg("somme_depart_arrivee").over(Window.partitionBy(airport))
    percent = F.col("pourcentage_ecart_moyenne")
    return (
        counted.withColumn("somme_depart_arrivee", total)
        .withColumn("pourcentage_ecart_moyenne", percent_deviation(F.col("somme_depart_arrivee"), mean))
        .withColumn("congestion", over(percent, threshold))
    )


def lookup_table(congestion: DataFrame, order: list[str] | None = None) -> DataFrame:
    """First row per (day, airport), measured for broadcast, ready for ``add_congestion``."""
    order = order or [c for c in MEASURES if c in congestion.columns]
    keyed = congestion.withColumn("airport", F.upper(F.trim("airport")))
    first = keep_first(keyed, ["flight_date", "airport"], [F.col(c).asc_nulls_last() for c in order])
    return sized(first.select("flight_date", "airport", *[c for c in MEASURES if c in congestion.columns]))


def add_congestion(flights: DataFrame, table: DataFrame) -> DataFrame:
    """Congestion of the day at both ends: ``*_source`` and ``*_destination``, null if unknown."""
    out = flights
    for end, suffix in (("airport_origin", "_source"), ("airport_destination", "_destination")):
        side = table.select(
            "flight_date", "airport", *[F.col(c).alias(c + suffix) for c in MEASURES if c in table.columns]
        )
        out = attach(out, side, {"flight_date": "flight_date", end: "airport"})
    return out


def add_movement_counts(flights: DataFrame, table: DataFrame) -> DataFrame:
    """Departures and arrivals of the day at both ends as ``NBVols_*`` columns."""
    out = flights
    for end, label in (("airport_origin", "Origin"), ("airport_destination", "Destination")):
        side = table.select(
            "flight_date",
            "airport",
            F.col("nombre_departs").alias(f"NBVols_Depart_Airport_{label}"),
            F.col("nombre_arrivees").alias(f"NBVols_Arrivee_Airport_{label}"),
        )
        out = attach(out, side, {"flight_date": "flight_date", end: "airport"})
    return out
