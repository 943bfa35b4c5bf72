"""Landed flight boards (nested JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyloom.schemas import BOARD, BOARD_FLIGHT


def read_boards(spark: SparkSession, path: str, layout: StructType = BOARD) -> DataFrame:
    """One row per landed reply: airport asked, slot, departures and arrivals.

    ``RECORD_BOARD`` as layout reads the fields of movement records only.
    """
    return spark.read.schema(layout).option("multiLine", False).json(path)


def read_flight_replies(spark: SparkSession, path: str) -> DataFrame:
    """Replies to single-flight requests: each file is a JSON array of flights."""
    return spark.read.schema(BOARD_FLIGHT).option("multiLine", True).json(path)
