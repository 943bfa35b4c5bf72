"""Requests -> flights: one answer per request, for whole tables of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import MATCH_TOLERANCE_MINUTES
from skyloom.functions.text import airport_code, day_and_hour, flight_code
from skyloom.functions.times import clock_minutes, minute_of_day, wall_clock
from skyloom.operators.distinct import keep_first
from skyloom.operators.lookup import sized
from skyloom.session import stored

FOUND = ["flight_number", "scheduled_departure", "airport_origin", "airport_destination"]
QUESTION = ["number", "day", "hour", "origin", "destination"]


def matches_number(principal: Column, codeshares: Column, requested: Column) -> Column:
    """The request names the flight or one of its codeshares."""
    wanted = flight_code(requested)
    shared = F.exists(F.coalesce(codeshares, F.array().cast("array<string>")), lambda c: flight_code(c) == wanted)
    return (flight_code(principal) == wanted) | shared


def codeshare_only(principal: Column, codeshares: Column, requested: Column) -> Column:
    return matches_number(principal, codeshares, requested) & (flight_code(principal) != flight_code(requested))


def questions(requests: DataFrame) -> DataFrame:
    """Requests with normalised number, day, hour and airports. A day alone asks for no hour."""
    when = day_and_hour(F.col("date"), bare_day_hour="")

    def airport(name: str) -> Column:
        return F.upper(F.coalesce(airport_code(F.col(name)), F.lit("")))

    return requests.select(
        "request_id",
        flight_code(F.col("flight_number")).alias("number"),
        when["day"].alias("day"),
        when["hour"].alias("hour"),
        airport("departure_airport").alias("origin"),
        airport("arrival_airport").alias("destination"),
    )


def candidates(flights: DataFrame, order: list[str], asked: DataFrame | None = None) -> DataFrame:
    """Flights by every number they can be asked under; only those of a (number, day) in ``asked``, when that is given.

    Only the ends and the minute of departure decide a match, so flights that agree in these
    are reduced to the first one, before and after the shuffle: what a request has to be
    compared with does not grow with the number of copies of a flight.
    """
    names = F.array("flight_number")
    if "codeshares" in flights.columns:
        names = F.concat(names, F.coalesce(F.col("codeshares"), F.array().cast("array<string>")))
    rows = flights.select("*", F.explode(names).alias("__name")).select(
        flight_code(F.col("__name")).alias("number"),
        F.col("flight_date").cast("string").alias("day"),
        F.coalesce(F.upper(F.trim("airport_origin")), F.lit("")).alias("from"),
        F.coalesce(F.upper(F.trim("airport_destination")), F.lit("")).alias("to"),
        minute_of_day(wall_clock(F.col("scheduled_departure"))).alias("minute"),
        flight_code(F.col("flight_number")).alias("principal"),
        *[F.col(c).alias(f"place_{i}") for i, c in enumerate(order)],
        F.struct(*FOUND).alias("flight"),
    )
    if asked is not None:
        # Before the ranking, so that flights nobody asks for are neither ranked nor moved.
        rows = of_questions(rows, asked)
    return keep_first(rows, ["number", "day", "from", "to", "minute"], _places(order))


def of_questions(offered: DataFrame, asked: DataFrame) -> DataFrame:
    """Candidates of a (number, day) that some question names; the keys are measured for broadcast."""
    return offered.join(sized(asked.select("number", "day").distinct()), ["number", "day"], "left_semi")


def _places(order: list[str]) -> list[Column]:
    return [F.col(f"place_{i}").asc_nulls_last() for i in range(len(order))]


def prepared(flights: DataFrame, order: list[str]) -> DataFrame:
    """Candidates stored once for many batches of requests, sorted so that a day's rows lie together."""
    return stored(candidates(flights, order).sortWithinPartitions("day", "number"))


def on_days_asked(offered: DataFrame, requests: DataFrame, most: int = 1000) -> DataFrame:
    """Candidates of the days a small batch asks for; the filter reaches the scan.

    A batch with more than ``most`` days reads all candidates instead.
    """
    days = [r["day"] for r in questions(requests).select("day").distinct().limit(most + 1).collect()]
    return offered.where(F.col("day").isin(days)) if len(days) <= most else offered


def match(
    requests: DataFrame, flights: DataFrame, order: list[str], tolerance: int = MATCH_TOLERANCE_MINUTES
) -> DataFrame:
    """The flight each request means, or why there is none.

    Number first; then the origin if any flight agrees; then the destination likewise; then
    the nearest departure time, unless it is further than ``tolerance``. ``order`` breaks ties
    and must tell flights apart.
    """
    return match_candidates(requests, candidates(flights, order, questions(requests)), order, tolerance)


# The flights a question weighs are those of its best level: both ends agree (3), the origin (2), the destination (1),
# else all flights of its number and day (0). Each level's flights are found under one key.
LEVEL_KEYS = {3: ["from", "to"], 2: ["from"], 1: ["to"], 0: []}
ASKED_AS = {"from": "origin", "to": "destination"}
FAR = 1_000_000


def _by_minute(offered: DataFrame, ends: list[str], order: list[str]) -> DataFrame:
    """Per (number, day, ends): the first flight (by order) of each minute, as one array of at most 1,441 entries."""
    keys = ["number", "day", *ends]
    places = [F.col(f"place_{i}") for i in range(len(order))]
    rank = F.struct(*[p for c in places for p in (c.isNull(), c)])
    entry = F.struct(rank.alias("rank"), F.struct("flight", "principal").alias("result"))
    if set(ends) == {"from", "to"}:  # candidates hold one flight per (number, day, from, to, minute) already
        per_minute = offered.select(*keys, "minute", entry.alias("e"))
    else:
        per_minute = offered.groupBy(*keys, "minute").agg(F.min(entry).alias("e"))
    return per_minute.groupBy(*keys).agg(F.collect_list(F.struct("minute", "e.rank", "e.result")).alias("flights"))


def match_candidates(
    requests: DataFrame, offered: DataFrame, order: list[str], tolerance: int = MATCH_TOLERANCE_MINUTES
) -> DataFrame:
    """``match`` against candidates made before.

    No question is paired with all flights of its number and day. For each level the flights are one row per key
    holding the first flight of each minute of the day; a question looks up the row of each level (a left join
    each) and takes the highest level that has one, so it meets rows of at most 1,441 entries however many
    flights or nameless requests a day has; the nearest minute (ties: the order) is taken from that row at once, so
    that a question carries one flight, not rows of flights, into the next join.
    """
    asked = questions(requests)
    named, found_none = F.col("destination") != "", F.col("best").isNull()
    gap = lambda f: F.when(F.col("wanted").isNotNull(), F.abs(f["minute"] - F.col("wanted")))
    keyed = F.transform("flights", lambda f: F.struct(F.coalesce(gap(f), F.lit(FAR)).alias("g"), f["rank"].alias("rank"), gap(f).alias("gap"), f["result"].alias("result")))
    # Through a list of one, so that the nearest is looked for once for both of its fields.
    nearest = F.get(F.transform(F.array(F.array_min(keyed)), lambda b: F.struct(b["gap"].alias("gap"), b["result"].alias("result"))), F.lit(0))
    # Equal questions are answered once.
    met = asked.select(*QUESTION).distinct().withColumn("wanted", F.when(F.col("hour") != "", clock_minutes(F.col("hour"))))
    carried = [*QUESTION, "wanted"]
    for value, ends in LEVEL_KEYS.items():
        table = _by_minute(offered, ends, order).withColumnsRenamed({e: ASKED_AS[e] for e in ends})
        met = met.join(table, ["number", "day", *[ASKED_AS[e] for e in ends]], "left")
        here = F.col("flights").isNotNull() & named if "to" in ends else F.col("flights").isNotNull()
        best = F.when(here, nearest) if value == max(LEVEL_KEYS) else F.coalesce("best", F.when(found_none & here, nearest))
        met = met.select(*carried, best.alias("best"))
    best = met.where("best is not null").select(*QUESTION, "best.gap", "best.result")
    near = F.col("gap").isNull() | (F.col("gap") <= tolerance)
    resolved = best.select(*QUESTION, "gap", F.when(near, F.col("result")).alias("result"), F.lit(True).alias("__seen"))
    missing, found = F.col("__seen").isNull(), F.col("result").isNotNull()
    joined = asked.join(resolved, QUESTION, "left")
    shared = F.col("result.principal") != F.col("number")
    return joined.select(
        "request_id",
        F.when(missing, "error_flight_not_found")
        .when(~found, "error_time_mismatch")
        .when(shared, "success_with_warning_codeshare")
        .otherwise("success")
        .alias("status"),
        F.when(missing, "FLIGHT_NOT_FOUND").when(~found, "TIME_MISMATCH").alias("error_code"),
        F.col("result.flight.flight_number").alias("matched_flight_number"),
        F.col("result.flight.scheduled_departure").alias("matched_scheduled_departure"),
        F.col("result.flight.airport_origin").alias("matched_departure_airport"),
        F.col("result.flight.airport_destination").alias("matched_arrival_airport"),
        F.col("gap").alias("best_time_diff_minutes"),
    )
