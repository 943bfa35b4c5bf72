"""Table layouts, and one function that gives a table a layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from skyloom.functions.values import without_nan

TEXT, INT, REAL, DAY, MOMENT = StringType(), IntegerType(), DoubleType(), DateType(), TimestampType()


def _layout(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


MOVEMENT = _layout(
    flight_date=TEXT,
    movement_date=TEXT,
    flight_number=TEXT,
    airline=TEXT,
    airport_origin=TEXT,
    airport_destination=TEXT,
    terminal_departure=TEXT,
    terminal_arrival=TEXT,
    scheduled_departure=TEXT,
    scheduled_arrival=TEXT,
    estimated_departure=TEXT,
    estimated_arrival=TEXT,
    actual_departure=TEXT,
    actual_arrival=TEXT,
    actual_source_departure=TEXT,
    actual_source_arrival=TEXT,
    departure_delay_min=INT,
    departure_advance_min=INT,
    arrival_delay_min=INT,
    arrival_advance_min=INT,
    status=TEXT,
    movement_type=TEXT,
)

WEATHER = _layout(
    time=MOMENT,
    icao=TEXT,
    relative_humidity_2m=REAL,
    dew_point=REAL,
    icing_conditions=TEXT,
    rain=REAL,
    freezing_rain=TEXT,
    snow=REAL,
    thunderstorms=TEXT,
    pressure_msl=REAL,
    wind_shear=REAL,
    wind_gusts_10m=REAL,
    wind_speed_10m=REAL,
    wind_direction_10m=REAL,
    precipitation=REAL,
    has_precipitation=TEXT,
    fog=TEXT,
    humidity=REAL,
    temperature_2m=REAL,
    cloud_cover=REAL,
    cloud_base=REAL,
    visibility=REAL,
)

RAW_WEATHER = _layout(
    time=TEXT,
    icao=TEXT,
    temperature_2m=REAL,
    relative_humidity_2m=REAL,
    dew_point_2m=REAL,
    rain=REAL,
    snowfall=REAL,
    pressure_msl=REAL,
    wind_gusts_10m=REAL,
    wind_speed_10m=REAL,
    wind_direction_10m=REAL,
    wind_speed_100m=REAL,
    wind_direction_100m=REAL,
    precipitation=REAL,
    cloud_cover=REAL,
    cloud_base=REAL,
    weather_code=INT,
)

ARTICLE = _layout(title=TEXT, link=TEXT, pub_date=MOMENT, description=TEXT, source=TEXT)

REQUEST = _layout(
    request_id=TEXT, flight_number=TEXT, date=TEXT, departure_airport=TEXT, arrival_airport=TEXT
)

_CLOCK = _layout(utc=TEXT, local=TEXT)
_AIRPORT = _layout(
    icao=TEXT,
    iata=TEXT,
    name=TEXT,
    shortName=TEXT,
    municipalityName=TEXT,
    location=_layout(lat=REAL, lon=REAL),
    countryCode=TEXT,
    timeZone=TEXT,
)
_SIDE = _layout(
    airport=_AIRPORT,
    scheduledTime=_CLOCK,
    revisedTime=_CLOCK,
    predictedTime=_CLOCK,
    actualTime=_CLOCK,
    terminal=TEXT,
    quality=ArrayType(TEXT),
)
BOARD_FLIGHT = _layout(
    number=TEXT,
    status=TEXT,
    codeshareStatus=TEXT,
    isCargo=BooleanType(),
    lastUpdatedUtc=TEXT,
    codeshares=TEXT,
    airline=_layout(name=TEXT, iata=TEXT, icao=TEXT),
    aircraft=_layout(model=TEXT),
    greatCircleDistance=_layout(meter=REAL, km=REAL, mile=REAL, nm=REAL, feet=REAL),
    departure=_SIDE,
    arrival=_SIDE,
)
BOARD = _layout(
    queried_airport=TEXT,
    slot_start=TEXT,
    departures=ArrayType(BOARD_FLIGHT),
    arrivals=ArrayType(BOARD_FLIGHT),
)


def _part(layout: StructType, **wanted) -> StructType:
    """The named fields of a layout; ``None`` takes a field whole, a dict parts of it."""
    return StructType([StructField(n, layout[n].dataType if more is None else _part(layout[n].dataType, **more)) for n, more in wanted.items()])


_SIDE_READ = dict(
    airport=dict(iata=None), scheduledTime=dict(local=None), revisedTime=dict(local=None), actualTime=dict(local=None), terminal=None
)
# What movement records are made of: the JSON reader makes every field of its layout for every flight, so the rest is left out there.
RECORD_FLIGHT = _part(
    BOARD_FLIGHT, number=None, status=None, codeshares=None, airline=dict(name=None), departure=_SIDE_READ, arrival=_SIDE_READ
)
RECORD_BOARD = _layout(
    queried_airport=TEXT,
    slot_start=TEXT,
    departures=ArrayType(RECORD_FLIGHT),
    arrivals=ArrayType(RECORD_FLIGHT),
)


class MissingColumns(ValueError):
    """A table lacks columns it cannot do without."""


def require(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, layout: StructType, required=()) -> DataFrame:
    """Exactly the columns of ``layout``, in its order and types; absent ones and NaN are null."""
    require(df, required)
    return without_nan(df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in layout.fields
        ]
    ))
