"""Landed news feeds (RSS)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.functions.times import feed_instant
from skyloom.schemas import ARTICLE

ITEM = (
    "title string, link string, pubDate string, description string, "
    "source struct<_VALUE: string, _url: string>"
)


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Articles of all feeds; a date that cannot be read is null."""
    items = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)

    def text(name: str):
        return F.coalesce(F.trim(F.col(name)), F.lit(""))

    return items.select(
        text("title").alias("title"),
        text("link").alias("link"),
        feed_instant(F.col("pubDate")).alias("pub_date"),
        text("description").alias("description"),
        text("source._VALUE").alias("source"),
    ).select(*ARTICLE.fieldNames())
