"""Times: board timestamps, delays, day ranges and the French holiday calendar."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyloom.constants import EASTER_HOLIDAYS, FIXED_HOLIDAYS


def instant(c: Column) -> Column:
    """Board time with offset or ``Z`` -> instant; unreadable values become null.

    Seconds are put in where they are missing: a plain cast then reads the text, which is many
    times faster than parsing by pattern.
    """
    seconds_missing = F.substring(c, 17, 1).isin("Z", "+", "-")
    whole = F.when(seconds_missing, F.concat(F.substring(c, 1, 16), F.lit(":00"), F.substring(c, 17, 30))).otherwise(c)
    return F.when(F.substring(c, 5, 1) == "-", whole.try_cast("timestamp"))


def wall_clock(c: Column) -> Column:
    """Board time as read on the airport's clock; the offset is ignored."""
    return F.substring(c, 1, 16).try_cast("timestamp_ntz")


def feed_instant(c: Column) -> Column:
    """News feed date (RFC 822) -> instant; a date without zone is UTC."""
    text = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")),
    )


def hour_floor(c: Column) -> Column:
    return F.date_trunc("hour", c)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole minutes between two instants, cut toward zero."""
    seconds = F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))
    return (seconds / 60).cast("int")


def delay_and_advance(reference: Column, scheduled: Column) -> Column:
    """``struct<delay, advance>`` in minutes; both null when a time is missing."""
    return late_and_early(minutes_between(reference, scheduled))


def late_and_early(minutes: Column) -> Column:
    """``struct<delay, advance>`` of a difference in minutes; both null when it is missing."""
    zero = F.lit(0)
    return F.struct(
        F.when(minutes.isNotNull(), F.greatest(minutes, zero)).alias("delay"),
        F.when(minutes.isNotNull(), F.greatest(-minutes, zero)).alias("advance"),
    )


def minute_of_day(c: Column) -> Column:
    """Minutes since midnight of a wall-clock value."""
    return F.hour(c) * 60 + F.minute(c)


def clock_minutes(c: Column) -> Column:
    """``HH:MM`` text -> minutes since midnight; null when unreadable."""
    return (
        F.regexp_extract(c, r"^(\d{1,2}):(\d{1,2})$", 1).try_cast("int") * 60
        + F.regexp_extract(c, r"^(\d{1,2}):(\d{1,2})$", 2).try_cast("int")
    )


def time_of_day_gap(scheduled: Column, requested: Column) -> Column:
    """Absolute gap in minutes between a board time and ``HH:MM``; midnight is not wrapped."""
    return F.abs(minute_of_day(wall_clock(scheduled)) - clock_minutes(requested))


def days(first: Column, last: Column) -> Column:
    """Array of days, both ends included; empty when the range is empty."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def half_day_slots(start: Column, end: Column) -> Column:
    """Half-open 12-hour slots of a range as ``array<struct<slot_start, slot_end>>``."""
    step = F.expr("interval 12 hours")
    starts = F.when(start < end, F.sequence(start, end - F.expr("interval 1 microsecond"), step))
    return F.transform(
        starts, lambda s: F.struct(s.alias("slot_start"), F.least(s + step, end).alias("slot_end"))
    )


def half_day_slot(c: Column) -> Column:
    """Start of the 12-hour slot, counted from midnight, that holds a time."""
    return F.timestamp_add("HOUR", F.when(F.hour(c) < 12, 0).otherwise(12), F.date_trunc("day", c))


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by Oudin's form of the computus (1940).

    The Paschal full moon and the weekday that follows it give the days from 28 March.
    """

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden, century = year % 19, div(year, 100)
    moon = (century - div(century, 4) - div(century * 8 + 13, 25) + golden * 19 + 15) % 30
    late = (moon == 29) | ((moon == 28) & (golden > 10))
    full_moon = moon - late.cast("int")
    weekday = (year + div(year, 4) + full_moon + 2 - century + div(century, 4)) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), full_moon - weekday)


def public_holiday(day: Column) -> Column:
    """Label of a French public holiday; null on other days. Holds for any year."""
    since_easter = F.datediff(day, easter(F.year(day)))
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    # A movable holiday that falls on a fixed one (Ascension on 1 or 8 May) gives its own label.
    rules = [(since_easter == n, label) for n, label in EASTER_HOLIDAYS]
    rules += [(month_day == m * 100 + d, label) for m, d, label in FIXED_HOLIDAYS]
    result = None
    for test, label in rules:
        result = F.when(test, label) if result is None else result.when(test, label)
    return result


def weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")
