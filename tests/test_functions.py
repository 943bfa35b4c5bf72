"""Column functions on small typed tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyloom.functions import text, times, values, weather
from skyloom.operators import movements as mov


def one(spark, expr, **columns):
    schema = ", ".join(f"{k} {v[1]}" for k, v in columns.items())
    df = spark.createDataFrame([tuple(v[0] for v in columns.values())], schema) if columns else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def column(spark, values_, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, c {kind}")
    return [r["x"] for r in df.orderBy("i").select(expr.alias("x")).collect()]


C = F.col("c")


def test_flight_code(spark):
    assert column(spark, ["af 7310", " AF7310 ", "", None], "string", text.flight_code(C)) == ["AF7310", "AF7310", "", ""]


def test_airport_code(spark):
    got = column(spark, ["CDG - Paris Charles de Gaulle", " ORY ", "A-B", None], "string", text.airport_code(C))
    assert got == ["CDG", "ORY", "A-B", None]


def test_plain_text(spark):
    got = column(
        spark,
        ["  Grève   à Orly ! ", "C&ocirc;te d&#39;Azur", "&amp;lt; &#xE9;t&#233;", "cœur", None],
        "string",
        text.plain_text(C),
    )
    assert got == ["greve a orly !", "cote d'azur", "&lt; ete", "coeur", ""]


def test_contains_any(spark):
    got = column(spark, ["mouvement social a nice", "niceness", "rien"], "string", text.contains_any(C, ["nice"]))
    assert got == [True, True, False]
    whole = column(spark, ["a nice", "niceness"], "string", text.contains_any(C, ["nice"], whole_words=True))
    assert whole == [True, False]


def test_hours(spark):
    assert column(spark, ["2026-04-23 12:40+02:00", "x 09:05:07", "none", None], "string", text.hour_text(C)) == [
        "12:40", "09:05:07", "", "",
    ]
    assert column(spark, ["2026-04-23 12:40", "none", None], "string", text.hour_number(C)) == [12, 0, 0]


def test_day_and_hour(spark):
    got = column(spark, ["2026-04-23T12:40", "2026-04-23 12:40:10", "2026-04-23", "soon 7h", "", None], "string", text.day_and_hour(C))
    assert [tuple(r) for r in got] == [
        ("2026-04-23", "12:40"), ("2026-04-23", "12:40"), ("2026-04-23", "00:00"), ("soon", "7h"), ("", ""), ("", ""),
    ]


@pytest.mark.parametrize("number,ok", [("AF1234", True), ("ba 456", True), ("AFRX1", False), ("AF", False), ("AF123456", False), (None, False)])
def test_valid_flight_number(spark, number, ok):
    assert column(spark, [number], "string", text.valid_flight_number(C)) == [ok]


def test_instant_and_wall_clock(spark):
    samples = ["2026-04-23 12:40+02:00", "2026-04-23 10:40Z", "2026-04-23T12:40:30+02:00", "bad", None]
    utc = dt.datetime(2026, 4, 23, 10, 40)
    got = column(spark, samples, "string", times.instant(C).cast("string"))
    assert got[:2] == [str(utc), str(utc)] and got[2] == "2026-04-23 10:40:30" and got[3:] == [None, None]
    clock = column(spark, samples[:2] + ["bad"], "string", times.wall_clock(C))
    assert clock == [dt.datetime(2026, 4, 23, 12, 40), dt.datetime(2026, 4, 23, 10, 40), None]


def test_feed_instant(spark):
    got = column(
        spark,
        ["Wed, 22 Apr 2026 08:00:00 GMT", "Wed, 22 Apr 2026 01:00:00 +0200", "2 Apr 2026 08:00:00", "nope"],
        "string",
        times.feed_instant(C).cast("string"),
    )
    assert got == ["2026-04-22 08:00:00", "2026-04-21 23:00:00", "2026-04-02 08:00:00", None]


@pytest.mark.parametrize(
    "actual,planned,expected",
    [
        ("2026-01-01 10:20Z", "2026-01-01 10:00Z", (20, 0)),
        ("2026-01-01 10:00Z", "2026-01-01 10:00Z", (0, 0)),
        ("2026-01-01 09:50Z", "2026-01-01 10:00Z", (0, 10)),
        ("2026-01-01 09:59:30Z", "2026-01-01 10:00:00Z", (0, 0)),
        (None, "2026-01-01 10:00Z", (None, None)),
        # Across the change to summer time.
        ("2026-03-29 03:10+02:00", "2026-03-29 01:55+01:00", (15, 0)),
    ],
)
def test_delay_and_advance(spark, actual, planned, expected):
    df = spark.createDataFrame([(actual, planned)], "a string, p string")
    row = df.select(times.delay_and_advance(times.instant(F.col("a")), times.instant(F.col("p"))).alias("x")).first()["x"]
    assert tuple(row) == expected


def test_time_of_day_gap_does_not_wrap(spark):
    df = spark.createDataFrame([("2026-01-01 23:55+01:00", "00:05"), ("2026-01-01 10:00Z", "x")], "a string, h string")
    got = [r["x"] for r in df.select(times.time_of_day_gap(F.col("a"), F.col("h")).alias("x")).collect()]
    assert got == [1430, None]


def test_half_day_slots(spark):
    df = spark.sql("select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-02 06:00:00' b")
    got = df.select(F.explode(times.half_day_slots(F.col("a"), F.col("b"))).alias("s")).select("s.*").collect()
    hours = [(r["slot_start"].strftime("%d %H"), r["slot_end"].strftime("%d %H")) for r in got]
    assert hours == [("01 00", "01 12"), ("01 12", "02 00"), ("02 00", "02 06")]
    empty = spark.sql("select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-01 00:00:00' b")
    assert empty.select(F.explode(times.half_day_slots(F.col("a"), F.col("b")))).count() == 0


@pytest.mark.parametrize("year,day", [(2024, "2024-03-31"), (2025, "2025-04-20"), (2026, "2026-04-05"), (2038, "2038-04-25"), (1981, "1981-04-19"), (2000, "2000-04-23")])
def test_easter(spark, year, day):
    assert str(one(spark, times.easter(F.lit(year)))) == day


def test_public_holidays(spark):
    days = spark.sql("select explode(sequence(date'2025-01-01', date'2025-12-31')) d")
    found = {str(r["d"]): r["h"] for r in days.select("d", times.public_holiday(F.col("d")).alias("h")).where("h is not null").collect()}
    assert len(found) == 11
    assert found["2025-04-21"] == "Lundi de Pâques" and found["2025-05-29"] == "Ascension"
    assert found["2025-06-09"] == "Lundi de Pentecôte" and found["2025-11-11"] == "Armistice 1918"
    # Ascension on 1 May 2008 keeps its own name.
    assert one(spark, times.public_holiday(F.lit("2008-05-01").cast("date"))) == "Ascension"
    assert one(spark, times.public_holiday(F.lit("2026-01-01").cast("date"))) == "Jour de l'an"


def test_weekend(spark):
    assert column(spark, ["2026-04-24", "2026-04-25", "2026-04-26"], "string", times.weekend(C.cast("date"))) == [0, 1, 1]


def test_wind_shear(spark):
    df = spark.createDataFrame([(10.0, 0.0, 10.0, 180.0), (10.0, None, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r["x"] for r in df.select(weather.wind_shear(*map(F.col, "abcd")).alias("x")).collect()]
    assert got == [20.0, None]


@pytest.mark.parametrize(
    "t,rh,p,code,dew,expected,with_dew",
    [
        (2.0, 90.0, 0.0, 0, 10.0, "Oui", "Oui"),
        (2.1, 95.0, 1.0, 45, 2.0, "Non", "Non"),
        (1.0, 50.0, 0.1, 0, 9.0, "Oui", "Oui"),
        (1.0, 50.0, 0.0, 66, 9.0, "Oui", "Oui"),
        (1.0, 50.0, 0.0, 0, 0.5, "Non", "Oui"),
        (None, 95.0, 1.0, 45, 0.0, "Non", "Non"),
        (1.0, None, None, None, None, "Non", "Non"),
    ],
)
def test_icing(spark, t, rh, p, code, dew, expected, with_dew):
    df = spark.createDataFrame([(t, rh, p, code, dew)], "t double, rh double, p double, code int, dew double")
    args = [F.col(c) for c in ("t", "rh", "p", "code")]
    row = df.select(weather.icing(*args).alias("a"), weather.icing(*args, dew_point=F.col("dew")).alias("b")).first()
    assert (row["a"], row["b"]) == (expected, with_dew)


def test_weather_flags(spark):
    codes = [45, 56, 67, 95, 99, 0, None]
    assert column(spark, codes, "int", weather.fog(C)) == ["Oui"] + ["Non"] * 6
    assert column(spark, codes, "int", weather.freezing_rain(C)) == ["Non", "Oui", "Oui", "Non", "Non", "Non", "Non"]
    assert column(spark, codes, "int", weather.thunderstorms(C)) == ["Non"] * 3 + ["Oui", "Oui", "Non", "Non"]
    assert column(spark, [0.1, 0.0, None], "double", weather.has_precipitation(C)) == ["Oui", "Non", "Non"]


def test_values(spark):
    df = spark.createDataFrame([("", 5), ("missing value", 6), ("NaN", 7), (None, 8), ("3", 9)], "a string, d int")
    got = [r["x"] for r in df.select(values.arrival_delay(F.col("a"), F.col("d").cast("string")).alias("x")).collect()]
    assert got == ["5", "6", "7", "8", "3"]
    assert column(spark, [15.0, 15.1, None], "double", values.late_label(C)) == [0, 1, 0]
    assert column(spark, ["1", "1.0", "x", None], "string", values.flag(C)) == [1, 1, 0, 0]
    assert column(spark, [60.0, 30.0, 29.9], "double", values.risk_band(C)) == ["high", "medium", "low"]
    assert column(spark, [-2.0, 3.0], "double", values.not_negative(C)) == [0.0, 3.0]
    assert column(spark, ["", "a", None], "string", values.first_filled(C, F.lit("z"))) == ["z", "a", "z"]
    assert column(spark, [float("nan"), 1.0], "double", values.null_for_nan(C)) == [None, 1.0]


def test_percent_deviation_half_even(spark):
    df = spark.createDataFrame([(3.0, 2.0), (2.0, 0.0)], "v double, m double")
    got = [r["x"] for r in df.select(values.percent_deviation(F.col("v"), F.col("m")).alias("x")).collect()]
    assert got == [50.0, None]


@pytest.mark.parametrize(
    "actual,revised,status,expected",
    [
        ("a", "r", "Expected", ("a", "actualTime")),
        (None, "r", " Arrived ", ("r", "revisedTime")),
        ("", "r", "Expected", (None, None)),
        (None, None, "landed", (None, None)),
        (None, "r", None, (None, None)),
    ],
)
def test_actual_or_revised(spark, actual, revised, status, expected):
    df = spark.createDataFrame([(actual, revised, status)], "a string, r string, s string")
    row = df.select(mov.actual_or_revised(*map(F.col, "ars")).alias("x")).first()["x"]
    assert tuple(row) == expected


def test_routes(spark):
    rows = [("CDG", "NCE"), ("NCE", "ORY"), ("CDG", "ORY"), ("NCE", "JFK"), ("JFK", None), (None, "CDG")]
    df = spark.createDataFrame(rows, "o string, d string")
    o, d = F.col("o"), F.col("d")
    got = df.select(mov.target_route(o, d), mov.domestic_route(o, d), mov.served_route(o, d)).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True), (True, True, True), (False, True, True),
        (False, False, True), (False, False, False), (False, False, True),
    ]
