"""Flight boards -> movement records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import AIRPORTS, FINAL_STATUSES, PARIS_AIRPORTS, REGIONAL_AIRPORTS
from skyloom.functions.text import day_text, status_key
from skyloom.functions.times import instant, late_and_early, minutes_between
from skyloom.functions.values import filled, first_filled
from skyloom.operators.distinct import keep_first
from skyloom.schemas import MOVEMENT

MERGE_KEYS = ["flight_number", "airline", "flight_date", "scheduled_departure", "scheduled_arrival"]
IDENTITY = [
    "flight_number", "flight_date", "airport_origin", "airport_destination",
    "scheduled_departure", "scheduled_arrival",
]
SORT = [
    "flight_date", "flight_number", "airport_origin", "airport_destination",
    "scheduled_departure", "scheduled_arrival",
]
READING_ORDER = ["queried_airport", "slot_start", "side_rank", "board_position"]


def estimated(revised: Column, scheduled: Column) -> Column:
    return first_filled(revised, scheduled)


def is_final(status: Column) -> Column:
    return status_key(status).isin(*FINAL_STATUSES)


def actual_or_revised(actual: Column, revised: Column, status: Column) -> Column:
    """``struct<time, source>``: the actual time, else the revised time of a finished flight."""
    return time_and_source(actual, revised, is_final(status))


def time_and_source(actual: Column, revised: Column, final: Column) -> Column:
    actual, revised = filled(actual), filled(revised)
    return F.struct(
        F.when(actual.isNotNull(), actual).when(final, revised).alias("time"),
        F.when(actual.isNotNull(), "actualTime")
        .when(final & revised.isNotNull(), "revisedTime")
        .alias("source"),
    )


def _present(c: Column) -> Column:
    """Python truth of a text: neither missing nor empty."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def target_route(origin: Column, destination: Column) -> Column:
    """Between Paris and one of the regional airports, either way."""
    test = (origin.isin(*PARIS_AIRPORTS) & destination.isin(*REGIONAL_AIRPORTS)) | (
        origin.isin(*REGIONAL_AIRPORTS) & destination.isin(*PARIS_AIRPORTS)
    )
    return F.coalesce(test, F.lit(False))


def domestic_route(origin: Column, destination: Column) -> Column:
    return F.coalesce(origin.isin(*AIRPORTS) & destination.isin(*AIRPORTS), F.lit(False))


def served_route(origin: Column, destination: Column) -> Column:
    """At least one end is a served airport."""
    return F.coalesce(origin.isin(*AIRPORTS), F.lit(False)) | F.coalesce(
        destination.isin(*AIRPORTS), F.lit(False)
    )


def valid_movement() -> Column:
    """Dated, of a known type and with an airport on its own side."""
    own = F.when(F.col("movement_type") == "departure", F.col("airport_origin")).when(
        F.col("movement_type") == "arrival", F.col("airport_destination")
    )
    return _present(F.col("movement_date")) & _present(own)


def codeshare_list(c: Column) -> Column:
    """Codeshares as an array: a JSON list is parsed, a single value is wrapped."""
    is_list = F.startswith(F.trim(c), F.lit("["))
    return (
        F.when(is_list, F.from_json(c, "array<string>"))
        .when(_present(c), F.array(c))
        .otherwise(F.array().cast("array<string>"))
    )


def board_flights(boards: DataFrame) -> DataFrame:
    """One row per flight and board side, with its place in the reading order."""

    def side(array: str, kind: str, rank: int) -> Column:
        return F.transform(
            F.coalesce(F.col(array), F.array().cast(boards.schema[array].dataType)),
            lambda flight, place: F.struct(
                F.lit(rank).alias("side_rank"), F.lit(kind).alias("movement_type"),
                place.alias("board_position"), flight.alias("flight"),
            ),
        )

    # One explode of both arrays, so each board is read and parsed once.
    both = F.concat(side("departures", "departure", 0), side("arrivals", "arrival", 1))
    return boards.select("queried_airport", "slot_start", F.explode(both).alias("seen")).select(
        "queried_airport", "slot_start", "seen.*"
    )


def seen_flights(flights: DataFrame) -> DataFrame:
    """The parts of ``board_flights`` that records are made of, as plain columns; one end is always the airport that was asked."""
    f = F.col("flight")
    departing = F.col("movement_type") == "departure"
    sd, rd, ad = (f["departure"][t]["local"] for t in ("scheduledTime", "revisedTime", "actualTime"))
    sa, ra, aa = (f["arrival"][t]["local"] for t in ("scheduledTime", "revisedTime", "actualTime"))
    return flights.select(
        f["number"].alias("flight_number"),
        f["airline"]["name"].alias("airline"),
        F.when(departing, F.col("queried_airport")).otherwise(f["departure"]["airport"]["iata"]).alias("airport_origin"),
        F.when(departing, f["arrival"]["airport"]["iata"]).otherwise(F.col("queried_airport")).alias("airport_destination"),
        f["departure"]["terminal"].alias("terminal_departure"),
        f["arrival"]["terminal"].alias("terminal_arrival"),
        sd.alias("scheduled_departure"),
        sa.alias("scheduled_arrival"),
        rd.alias("revised_departure"),
        ra.alias("revised_arrival"),
        ad.alias("actual_departure"),
        aa.alias("actual_arrival"),
        f["status"].alias("status"),
        "movement_type",
        f["codeshares"].alias("codeshares"),
        *[c for c in READING_ORDER if c in flights.columns],
    )


def dated(seen: DataFrame) -> DataFrame:
    """``seen_flights`` with the day of the flight and of the movement."""
    sd, sa = F.col("scheduled_departure"), F.col("scheduled_arrival")
    own_schedule = F.when(F.col("movement_type") == "departure", sd).otherwise(sa)
    return seen.withColumns(
        {"flight_date": day_text(first_filled(sd, sa)), "movement_date": day_text(filled(own_schedule))}
    )


def timed(seen: DataFrame) -> DataFrame:
    """``seen_flights`` -> movement records: estimated and actual times, delays and codeshares.

    What is used more than once is a column of its own first: written out at each use, the generated method would be
    too long to be compiled to machine code.
    """
    c = F.col
    keyed = dated(seen).withColumn("__final", is_final(c("status")))
    chosen = keyed.withColumns(
        {
            "estimated_departure": estimated(c("revised_departure"), c("scheduled_departure")),
            "estimated_arrival": estimated(c("revised_arrival"), c("scheduled_arrival")),
            "__dep": time_and_source(c("actual_departure"), c("revised_departure"), c("__final")),
            "__arr": time_and_source(c("actual_arrival"), c("revised_arrival"), c("__final")),
        }
    ).withColumns(
        {
            "actual_departure": c("__dep.time"),
            "actual_arrival": c("__arr.time"),
            "actual_source_departure": c("__dep.source"),
            "actual_source_arrival": c("__arr.source"),
        }
    )
    counted = chosen.withColumns(
        {f"__{end}": minutes_between(instant(c(f"actual_{end}")), instant(c(f"scheduled_{end}"))) for end in ("departure", "arrival")}
    )
    gaps = {end: late_and_early(c(f"__{end}")) for end in ("departure", "arrival")}
    delays = counted.withColumns(
        {f"{end}_{what}_min": gap[what] for end, gap in gaps.items() for what in ("delay", "advance")}
        | {"codeshares": codeshare_list(c("codeshares"))}
    )
    return delays.select(*MOVEMENT.fieldNames(), "codeshares", *[c for c in READING_ORDER if c in seen.columns])


def records(flights: DataFrame) -> DataFrame:
    """Movement records of ``board_flights``; one end is always the airport that was asked."""
    return timed(seen_flights(flights))


def departure_records(flights: DataFrame, queried_airport: str | Column) -> DataFrame:
    """Departure records of a plain table of board flights (the reply to one flight request)."""
    airport = F.lit(queried_airport) if isinstance(queried_airport, str) else queried_airport
    return records(
        flights.select(
            airport.alias("queried_airport"),
            F.lit("departure").alias("movement_type"),
            F.struct("*").alias("flight"),
        )
    ).drop("queried_airport")


def merge_records(df: DataFrame, order: list[str] = READING_ORDER, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """One row per flight; each column takes its first non-empty value in reading order.

    Every aggregate has a partial step, so a flight seen many times is reduced before the
    shuffle.
    """
    place = F.col("__place")
    merged = []
    for name, kind in df.dtypes:
        if name in keys or name in order:
            continue
        c = F.col(f"`{name}`")
        value = filled(c) if kind == "string" else F.when(F.size(c) > 0, c) if kind.startswith("array") else c
        merged.append(F.min_by(value, F.when(value.isNotNull(), place)).alias(name))
    out = df.withColumn("__place", F.struct(*order)).groupBy(*keys).agg(*merged)
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in order])


def movement_table(boards: DataFrame) -> DataFrame:
    """Target-route flights from landed boards."""
    return merged_flights(records(board_flights(boards)))


def target_only(flights: DataFrame) -> DataFrame:
    return flights.where(target_route(F.col("airport_origin"), F.col("airport_destination")))


def merged_flights(flights: DataFrame) -> DataFrame:
    """Movement records -> target-route flights: merged, deduplicated, one row per flight."""
    merged = target_only(merge_records(target_only(flights)))
    first = keep_first(merged, IDENTITY, [F.col(c).asc_nulls_last() for c in ("airline", "movement_date")])
    return first.select(*MOVEMENT.fieldNames(), "codeshares")


def sorted_movements(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in SORT])
