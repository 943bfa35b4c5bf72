"""Strike news -> one row per day with a flag and the titles of each airport."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.constants import AIRPORT_ALIASES, STRIKE_KEYWORDS
from skyloom.functions.text import contains_any, plain_text
from skyloom.functions.weather import yes_no
from skyloom.operators.lookup import attach, sized


def haystack() -> Column:
    """All text of an article, folded for comparison."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "description", "link", "source")]
    return plain_text(F.concat_ws(" ", *parts))


def matched_airports(
    text: Column,
    aliases: Mapping[str, Iterable[str]] = AIRPORT_ALIASES,
    keywords: Iterable[str] = STRIKE_KEYWORDS,
    whole_words: bool = False,
) -> Column:
    """Airports a folded text speaks of, provided it speaks of a strike."""
    named = F.array_compact(
        F.array(*[F.when(contains_any(text, words, whole_words), a) for a, words in aliases.items()])
    )
    return F.when(contains_any(text, keywords, whole_words), named).otherwise(F.array().cast("array<string>"))


def relevant(
    articles: DataFrame,
    aliases: Mapping[str, Iterable[str]] = AIRPORT_ALIASES,
    keywords: Iterable[str] = STRIKE_KEYWORDS,
    whole_words: bool = False,
) -> DataFrame:
    """One row per dated article and airport it is relevant for. The text is folded once."""
    folded = articles.where("pub_date is not null").withColumn("__text", haystack())
    return folded.select(
        *articles.columns,
        F.explode(matched_airports(F.col("__text"), aliases, keywords, whole_words)).alias("airport"),
    )


def unique_articles(found: DataFrame) -> DataFrame:
    """One article per airport, folded title, link and day (UTC): the earliest."""
    return (
        found.groupBy(
            "airport",
            F.to_date("pub_date").alias("day"),
            plain_text(F.col("title")).alias("folded_title"),
            F.coalesce("link", F.lit("")).alias("link"),
        )
        .agg(F.min(F.struct("pub_date", F.trim("title").alias("title"))).alias("first"))
        .select("airport", "day", "link", "first.pub_date", "first.title")
    )


def in_window(day: Column, as_of: Column, days_back: int = 364) -> Column:
    return day.between(F.date_sub(as_of, days_back), as_of)


def daily_titles(articles: DataFrame, airports: Iterable[str] = AIRPORT_ALIASES, titles_per_part: int = 50_000) -> DataFrame:
    """Per day, each airport's distinct titles in order of publication, joined by `` | ``.

    Copies of a title are removed by an aggregate of their own first. The titles are then laid out in the order
    (day, airport, publication, title) over ranges of about ``titles_per_part`` titles each, so a day with very many
    titles is spread over several tasks: each range joins its part of every (day, airport) in order, and a second
    level joins the parts of one (day, airport) in the order of their ranges. What one task gathers is the titles of
    one range, or one part per range of one day; only the result cell itself holds a whole day's titles.
    """
    titles = articles.where("title <> ''").groupBy("day", "airport", "title").agg(F.min("pub_date").alias("at"))
    wanted = list(airports)
    spark = titles.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-titles.count() // titles_per_part))
    ranged = titles.repartitionByRange(parts, "day", "airport", "at", "title").withColumn("part", F.spark_partition_id())
    first = ranged.groupBy("day", "airport", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "title"))), lambda t: t["title"]), " | ").alias("text")
    )
    joined = first.groupBy("day", "airport").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda t: t["text"]), " | ").alias("text")
    )
    label = lambda a: F.coalesce(F.first(F.when(F.col("airport") == a, F.col("text")), ignorenulls=True), F.lit(""))
    return joined.groupBy("day").agg(*[label(a).alias(f"LABEL_{a}") for a in wanted])


def strike_table(spine: DataFrame, titles: DataFrame, airports: Iterable[str] = AIRPORT_ALIASES) -> DataFrame:
    """All days of ``spine`` with ``GREVE_x`` (Oui/Non) and ``LABEL_x`` per airport."""
    joined = attach(spine, titles, {"date": "day"})
    columns = [F.col("date")]
    for a in airports:
        label = F.coalesce(F.col(f"LABEL_{a}"), F.lit(""))
        columns += [yes_no(label != "").alias(f"GREVE_{a}"), label.alias(f"LABEL_{a}")]
    return joined.select(*columns)


def add_strikes(flights: DataFrame, table: DataFrame, day: str = "flight_date") -> DataFrame:
    keyed = flights.withColumn("__day", F.trim(F.col(day).cast("string")).try_cast("date"))
    return attach(keyed, sized(table), {"__day": "date"}).drop("__day")
