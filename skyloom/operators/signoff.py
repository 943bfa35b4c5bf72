"""The final flight table: delay repair, late label, flags, and its indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.constants import LATE_AFTER_MINUTES
from skyloom.functions.text import upper_key
from skyloom.functions.values import arrival_delay, flag, late_label, share
from skyloom.operators.congestion import add_congestion
from skyloom.operators.shaping import drop_matching

LABEL = "retard arrivée"


def with_keys(flights: DataFrame) -> DataFrame:
    """Lookup keys without blanks, airports in capitals."""
    return flights.withColumns(
        {
            "flight_date": F.trim("flight_date"),
            "airport_origin": upper_key(F.col("airport_origin")),
            "airport_destination": upper_key(F.col("airport_destination")),
        }
    )


def label_flights(flights: DataFrame, late_after: float = LATE_AFTER_MINUTES) -> DataFrame:
    """Repair the arrival delay, label late flights, make congestion flags whole."""
    delay = arrival_delay(F.col("arrival_delay_min"), F.col("departure_delay_min"))
    repaired = flights.withColumn("arrival_delay_min", delay)
    flags = {c: flag(F.col(c)) for c in ("congestion_source", "congestion_destination") if c in flights.columns}
    return repaired.withColumns({LABEL: late_label(F.col("arrival_delay_min"), late_after), **flags})


def known_status(flights: DataFrame) -> DataFrame:
    """Drop flights whose status is "unknown"; a missing status stays."""
    return flights.where(F.coalesce(F.lower(F.trim("status")), F.lit("")) != "unknown")


def signoff(flights: DataFrame, congestion: DataFrame, late_after: float = LATE_AFTER_MINUTES) -> DataFrame:
    """Enriched flights + congestion lookup -> final table. Run ``indicators`` before ``finish``."""
    return label_flights(add_congestion(with_keys(flights), congestion), late_after)


def finish(labelled: DataFrame) -> DataFrame:
    return drop_matching(known_status(labelled))


def indicators(labelled: DataFrame, label: str = LABEL) -> DataFrame:
    """Percentages of late, congested and unknown flights; one pass, one row."""
    late, source, dest = F.col(f"`{label}`") == 1, F.col("congestion_source") == 1, F.col("congestion_destination") == 1
    unknown = F.lower(F.trim("status")) == "unknown"
    counts = labelled.agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(late).alias("late"),
        F.count_if(source).alias("source"),
        F.count("congestion_source").alias("source_known"),
        F.count_if(dest).alias("dest"),
        F.count("congestion_destination").alias("dest_known"),
        F.count_if(source & dest).alias("both"),
        F.count_if(source & late).alias("source_late"),
        F.count_if(dest & late).alias("dest_late"),
        F.count_if(unknown).alias("unknown"),
    )
    c = F.col
    return counts.select(
        "flights",
        share(c("late"), c("flights")).alias("pct_late"),
        share(c("dest"), c("dest_known")).alias("pct_congested_destination"),
        share(c("source"), c("source_known")).alias("pct_congested_source"),
        share(c("both"), c("flights")).alias("pct_congested_both"),
        share(c("source_late"), c("late")).alias("pct_source_when_late"),
        share(c("dest_late"), c("late")).alias("pct_destination_when_late"),
        share(c("unknown"), c("flights")).alias("pct_unknown_status"),
    )
