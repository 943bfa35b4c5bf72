"""Hourly weather: building the table and joining it to both ends of a flight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions import weather as fx
from skyloom.functions.times import hour_floor, instant
from skyloom.operators.distinct import keep_first
from skyloom.operators.lookup import attach, sized
from skyloom.operators.shaping import recode, suffixed
from skyloom.schemas import WEATHER, conform

SIDES = (
    ("_dep", "airport_origin", "scheduled_departure"),
    ("_arr", "airport_destination", "scheduled_arrival"),
)


def weather_table(raw: DataFrame, use_dew: bool = False) -> DataFrame:
    """Raw hourly measures -> weather table with flags; city names become IATA codes."""
    c = F.col
    flagged = raw.withColumnsRenamed({"dew_point_2m": "dew_point", "snowfall": "snow"}).withColumns(
        {
            "time": c("time").try_cast("timestamp"),
            "humidity": c("relative_humidity_2m"),
            "has_precipitation": fx.has_precipitation(c("precipitation")),
            "fog": fx.fog(c("weather_code")),
            "freezing_rain": fx.freezing_rain(c("weather_code")),
            "thunderstorms": fx.thunderstorms(c("weather_code")),
            "icing_conditions": fx.icing(
                c("temperature_2m"),
                c("relative_humidity_2m"),
                c("precipitation"),
                c("weather_code"),
                c("dew_point") if use_dew else None,
            ),
            "wind_shear": fx.wind_shear(
                c("wind_speed_10m"), c("wind_direction_10m"), c("wind_speed_100m"), c("wind_direction_100m")
            ),
            "visibility": F.lit(None).cast("double"),
        }
    )
    return recode(conform(flagged, WEATHER), "icao")


def weather_on_day(weather: DataFrame, day: Column) -> DataFrame:
    return weather.where(F.to_date("time") == day)


def hourly_lookup(weather: DataFrame, place: str = "icao", time: str = "time") -> DataFrame:
    """First row per (place, hour), measured for broadcast."""
    hourly = weather.withColumn("merge_hour", hour_floor(F.col(time)))
    rest = [c for c in weather.columns if c not in (place, time)]
    order = [F.col(c).asc_nulls_last() for c in (time, *rest)]
    return sized(keep_first(hourly, [place, "merge_hour"], order))


def join_hour(
    flights: DataFrame, lookup: DataFrame, place: str, hour: Column, suffix: str, lookup_place: str = "icao"
) -> DataFrame:
    """Left join the hour's weather; technical columns are dropped."""
    side = suffixed(lookup, suffix)
    keyed = flights.withColumn("__hour", hour)
    joined = attach(keyed, side, {place: lookup_place + suffix, "__hour": "merge_hour" + suffix})
    return joined.drop("__hour")


def add_weather(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather at origin (departure hour) and destination (arrival hour), matched as instants."""
    lookup = hourly_lookup(weather)
    out = flights
    for suffix, place, time in SIDES:
        out = join_hour(out, lookup, place, hour_floor(instant(F.col(time))), suffix)
    return out


def audit(enriched: DataFrame, weather: DataFrame, row_id: list[str]) -> DataFrame:
    """Every weather value of every flight beside the value recomputed from the weather table."""
    names = [f"{c}{s}" for s, *_ in SIDES for c in WEATHER.fieldNames() if c != "icao"]
    names = [n for n in names if n in enriched.columns]
    base = enriched.select(*row_id, *[c for _, *cs in SIDES for c in cs], *[F.col(n).alias("__" + n) for n in names])
    fresh = add_weather(base, weather)
    # One struct per column keeps both values of a cell together through a single explode.
    cells = F.array(
        *[
            F.struct(
                F.lit(n).alias("colonne"),
                F.col("__" + n).cast("string").alias("valeur"),
                F.col(n).cast("string").alias("verif"),
            )
            for n in names
        ]
    )
    return (
        fresh.select(*row_id, F.explode(cells).alias("cell"))
        .select(*row_id, "cell.*")
        .withColumn("same", F.col("valeur").eqNullSafe(F.col("verif")))
    )
