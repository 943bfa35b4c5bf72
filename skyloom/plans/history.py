"""Landed boards, weather, calendar and news -> the final flight table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from skyloom.constants import CONGESTION_OVER_PERCENT_BATCH, LATE_AFTER_MINUTES
from skyloom.operators import calendar as cal
from skyloom.operators import congestion as cong
from skyloom.operators import movements as mov
from skyloom.operators import signoff as sign
from skyloom.operators import strikes as news
from skyloom.operators.weather import add_weather
from skyloom.session import settle, stored


@dataclass(frozen=True)
class Rules:
    congestion_over: float = CONGESTION_OVER_PERCENT_BATCH
    late_after: float = LATE_AFTER_MINUTES
    trim_head: int = 3
    trim_tail: int = 1


def congestion_of(movements: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Flagged daily traffic of all routes that touch a served airport.

    Counts are stored once: they are small beside the movements and are read several times.
    """
    counted = settle(cong.counts(movements, mov.served_route))
    trimmed = cong.trim_ends(counted, ["flight_date", "airport"], rules.trim_head, rules.trim_tail)
    return cong.flagged(trimmed, rules.congestion_over)


def strikes_of(articles: DataFrame, first: str, last: str) -> DataFrame:
    spine = cal.day_spine(articles.sparkSession, first, last)
    unique = news.unique_articles(news.relevant(articles))
    kept = unique.where(F.col("day").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    return news.strike_table(spine, news.daily_titles(kept))


def enriched(
    flights: DataFrame, weather: DataFrame, calendar: DataFrame, strikes: DataFrame
) -> DataFrame:
    """Flights with weather at both ends, calendar and strikes. Every join keeps the row count."""
    return news.add_strikes(cal.add_calendar(add_weather(flights, weather), calendar), strikes)


def flight_history(
    boards: DataFrame, weather: DataFrame, articles: DataFrame, first: str, last: str, rules: Rules = Rules()
) -> DataFrame:
    """The labelled table before ``finish``; its only shuffle of flights is the record merge.

    Boards are parsed once: what was seen serves both the counts, which need its day and airports, and the flights, for
    which records are made on the target routes only.
    """
    seen = stored(mov.seen_flights(mov.board_flights(boards)))
    table = cong.lookup_table(congestion_of(mov.dated(seen), rules))
    flights = mov.merged_flights(mov.timed(mov.target_only(seen)))
    days = cal.calendar(cal.day_spine(boards.sparkSession, first, last))
    joined = enriched(flights, weather, days, strikes_of(articles, first, last))
    return sign.signoff(joined, table, rules.late_after)
