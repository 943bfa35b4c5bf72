"""Operators on small tables, each against plain Python or pandas."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from skyloom import schemas
from skyloom.operators import calendar as cal
from skyloom.operators import congestion as cong
from skyloom.operators import distinct as dis
from skyloom.operators import features as ft
from skyloom.operators import lookup
from skyloom.operators import matching as mat
from skyloom.operators import metrics as mt
from skyloom.operators import profile as prof
from skyloom.operators import ranking as rk
from skyloom.operators import repair as rep
from skyloom.operators import shaping as shp
from skyloom.operators import slices as sl
from skyloom.operators import strikes as news
from skyloom.operators import weather as wx


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


# Slices: many slices must give what one global window gives, also when one key is hot. -----


@pytest.fixture(scope="module")
def uneven(spark):
    """Two thousand rows; one key holds half of them, times and values repeat and are missing."""
    picker = random.Random(5)
    data = [
        (
            i,
            "hot" if picker.random() < 0.5 else picker.choice(["a", "b", None]),
            dt.datetime(2026, 1, 1) + dt.timedelta(minutes=picker.randrange(300)) if picker.random() < 0.9 else None,
            picker.random() if picker.random() < 0.2 else None,
            picker.choice("xyz") if 500 < i < 1500 and picker.random() < 0.1 else None,
        )
        for i in range(2000)
    ]
    return spark.createDataFrame(data, "id long, k string, t timestamp, v double, w string").repartition(7).cache()


ORDER = [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]


@pytest.mark.parametrize("size", [50, 10_000])
def test_fill_equals_global_window(uneven, size):
    got = sl.fill_both_ways(uneven, ["t", "id"], ["v", "w"], rows_per_slice=size)
    pdf = uneven.toPandas().sort_values(["t", "id"], na_position="last")
    expected = pdf[["v", "w"]].ffill().bfill().assign(id=pdf["id"]).set_index("id").sort_index()
    found = got.select("id", "v", "w").toPandas().set_index("id").sort_index()
    pd.testing.assert_frame_equal(found, expected[["v", "w"]], check_dtype=False)
    again = sl.fill_both_ways(got, ["t", "id"], ["v", "w"], rows_per_slice=size)
    assert same(again, got)


@pytest.mark.parametrize("size", [50, 10_000])
def test_ordinals_equal_row_number(uneven, size):
    got = sl.ordinals(uneven, ["k"], ["t", "id"], "n", rows_per_slice=size)
    expected = uneven.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*ORDER)) - 1)
    assert same(got, expected)


@pytest.mark.parametrize("size", [50, 10_000])
def test_running_totals(uneven, size):
    numbered = uneven.select("id", "t", F.lit(2).alias("two"))
    got = sl.running_totals(numbered, ["t", "id"], {"two": "before"}, rows_per_slice=size)
    assert sorted(r["before"] for r in got.collect()) == list(range(0, 4000, 2))
    place = sl.positions(uneven.select("t", "id"), ["t", "id"], "p", rows_per_slice=size)
    expected = uneven.select("t", "id", (F.row_number().over(Window.orderBy(*ORDER)) - 1).cast("bigint").alias("p"))
    assert same(place, expected)


def test_hot_key_is_spread(uneven):
    cut = sl.Slices(uneven, ["k", "t", "id"], rows_per_slice=100)
    sizes = [r["count"] for r in cut.assign(uneven).where("k = 'hot'").groupBy(sl.SLICE).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 400


# Repeated keys ----------------------------------------------------------------------------


def test_keep_first_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 3, "c"), (None, 2, "d")], "k int, o int, v string")
    got = dis.keep_first(df, ["k"], ["o"])
    assert rows(got, "k", "v") == [(1, "a"), (None, "d")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]


def test_keep_unique_and_repeated(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert rows(dis.keep_unique(df, ["k"])) == [(2, "c")]
    assert rows(dis.repeated_rows(df, ["k"]), "v") == [("a",), ("b",), ("d",), ("e",)]
    assert rows(dis.repeated_rows(df, ["k"], present=False), "v") == [("c",)]
    assert rows(dis.repeated_keys(df, ["k"])) == [(1, 2), (None, 2)]
    assert rows(dis.value_counts(df, "k")) == [(1, 2), (2, 1), (None, 2)]


# Repair -----------------------------------------------------------------------------------

SIDES = [
    ("AF1", "departure", "08:00", "dep-a"), ("AF1", "departure", "12:00", "dep-b"), ("AF1", "arrival", "13:00", "arr-a"),
    (None, "departure", "09:00", "dep-n"), (None, "arrival", "10:00", "arr-n"),
    ("BA2", "departure", "07:00", "single"),
]


@pytest.fixture(scope="module")
def sides(spark):
    data = [(n, "2026-01-01", "CDG", "NCE", k, t, t, v, v if k == "departure" else None) for n, k, t, v in SIDES]
    return spark.createDataFrame(
        data,
        "flight_number string, flight_date string, airport_origin string, airport_destination string, movement_type string,"
        " scheduled_departure string, scheduled_arrival string, note string, gate string",
    )


def test_repair_pairs_drops_the_unpaired(sides):
    got = rep.repair_pairs(sides)
    assert rows(got, "flight_number", "note", "note_dep", "note_arr", "n_vol") == [
        ("AF1", None, "dep-a", "arr-a", 0), ("BA2", "single", None, None, None), (None, None, "dep-n", "arr-n", 0),
    ]
    named = shp.harmonize(got.drop("scheduled_departure", "scheduled_arrival"), wide=True)
    assert "scheduled_departure" in named.columns and "scheduled_departure_dep" not in named.columns


def test_repair_left_keeps_the_unpaired(sides):
    got = rep.repair_left(sides)
    assert got.columns == sides.columns
    assert rows(got, "flight_number", "note", "gate") == [
        ("AF1", "dep-a", "dep-a"), ("AF1", "dep-b", "dep-b"), ("BA2", "single", "single"), (None, "dep-n", "dep-n"),
    ]


def test_repair_without_key_columns_is_a_no_op(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert rep.repair_pairs(df) is df


# Congestion -------------------------------------------------------------------------------


def test_counts_fill_zero_and_skip_invalid(spark):
    data = [
        ("2026-01-01", "departure", "CDG", "NCE"), ("2026-01-01", "departure", "CDG", None), ("2026-01-01", "arrival", "CDG", "NCE"),
        ("2026-01-01", "other", "CDG", "NCE"), (None, "departure", "CDG", "NCE"), ("2026-01-01", "arrival", "CDG", None), ("", "arrival", "A", "B"),
    ]
    df = spark.createDataFrame(data, "movement_date string, movement_type string, airport_origin string, airport_destination string")
    assert rows(cong.counts(df)) == [("2026-01-01", "CDG", 2, 0), ("2026-01-01", "NCE", 0, 1)]
    total = cong.counts(df).agg(F.sum(F.expr("nombre_departs + nombre_arrivees"))).first()[0]
    assert total == cong.own_side(df).count()
    scoped = {(r["scope"], r["airport"]): r["nombre_departs"] + r["nombre_arrivees"] for r in cong.counts_by_scope(df).collect()}
    assert scoped == {("cible", "CDG"): 1, ("cible", "NCE"): 1, ("france", "CDG"): 1, ("france", "NCE"): 1, ("ww", "CDG"): 2, ("ww", "NCE"): 1}


def test_flag_threshold_and_zero_mean(spark):
    data = [("d1", "A", 12, 0), ("d2", "A", 8, 0), ("d1", "Z", 0, 0)]
    df = spark.createDataFrame(data, "flight_date string, airport string, nombre_departs int, nombre_arrivees int")
    got = rows(cong.flagged(df, 20), "airport", "flight_date", "pourcentage_ecart_moyenne", "congestion")
    assert got == [("A", "d1", 20.0, 0), ("A", "d2", -20.0, 0), ("Z", "d1", None, 0)]
    assert rows(cong.flagged(df, 19.9), "airport", "flight_date", "congestion")[0] == ("A", "d1", 1)


def test_trim_of_a_short_table(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", "x")], "flight_date string, airport string")
    assert rows(cong.trim_ends(df, ["flight_date", "airport"]), "flight_date") == [("d",)]
    assert cong.trim_ends(df.limit(3), ["flight_date", "airport"]).isEmpty()


def test_lookup_takes_first_match_and_keeps_rows(spark):
    table = spark.createDataFrame(
        [("d", " cdg ", 1, 2, 3, 1), ("d", "CDG", 5, 5, 10, 0)],
        "flight_date string, airport string, nombre_departs int, nombre_arrivees int, somme_depart_arrivee int, congestion int",
    )
    flights = spark.createDataFrame([("d", "CDG", "NCE"), ("d", None, "CDG")], "flight_date string, airport_origin string, airport_destination string")
    got = cong.add_congestion(flights, cong.lookup_table(table))
    assert rows(got, "airport_origin", "somme_depart_arrivee_source", "somme_depart_arrivee_destination") == [("CDG", 3, None), (None, None, 3)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_oversized_lookup_is_not_broadcast(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    kept = lookup.sized(big, max_rows=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = lookup.attach(spark.range(5), kept, {"id": "k"})
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Weather, calendar, strikes ---------------------------------------------------------------


def raw_weather(spark, *readings):
    df = spark.createDataFrame(readings, "time string, icao string, temperature_2m double, weather_code int, wind_speed_10m double")
    return schemas.conform(df, schemas.RAW_WEATHER)


def test_weather_joins_by_instant(spark):
    weather = wx.weather_table(
        raw_weather(
            spark, ("2026-04-23T10:00", "ORLY", 1.0, 45, 5.0), ("2026-04-23T10:30", "ORLY", 9.0, 0, 9.0), ("2026-04-23T12:00", "NICE", 20.0, 95, 1.0)
        )
    )
    assert weather.columns == schemas.WEATHER.fieldNames()
    flights = spark.createDataFrame(
        [("AF1", "ORY", "NCE", "2026-04-23 12:40+02:00", "2026-04-23 14:20+02:00"), ("AF2", "ORY", "LYS", None, "2026-04-23 14:20+02:00")],
        "flight_number string, airport_origin string, airport_destination string, scheduled_departure string, scheduled_arrival string",
    )
    got = wx.add_weather(flights, weather)
    assert got.count() == 2 and "icao_dep" not in got.columns and "time_dep" in got.columns
    assert rows(got, "flight_number", "temperature_2m_dep", "fog_dep", "icing_conditions_dep", "thunderstorms_arr") == [
        ("AF1", 1.0, "Oui", "Oui", "Oui"), ("AF2", None, None, None, None),
    ]
    audit = wx.audit(got.withColumn("fog_dep", F.lit("Non")), weather, ["flight_number"])
    assert rows(audit.where("not same"), "flight_number", "colonne", "valeur", "verif") == [
        ("AF1", "fog_dep", "Non", "Oui"), ("AF2", "fog_dep", "Non", None),
    ]
    day = wx.weather_on_day(weather, F.lit("2026-04-23").cast("date"))
    assert day.count() == 3


def test_calendar(spark):
    spine = cal.day_spine(spark, "2025-01-01", "2026-02-28")
    table = {str(r["date"]): r.asDict() for r in cal.calendar(spine).collect()}
    assert len(table) == 424
    assert table["2025-04-21"]["Label Jour Ferié"] == "Lundi de Pâques"
    assert table["2025-07-14"]["Label des Vacances"] == "Vacances d'été" and table["2025-07-14"]["Jour férié"] == 1
    assert table["2025-02-15"]["Vacances Scolaires"] == "NICE, MARSEILLE, LYON"
    assert (table["2025-02-15"]["Vacances NCE"], table["2025-02-15"]["Vacances PRS"]) == (1, 0)
    assert table["2025-04-22"]["Vacances LYS"] == 0 and table["2025-04-21"]["Vacances LYS"] == 1
    assert table["2026-01-01"]["Jour férié"] == 1
    assert table["2025-03-01"]["Week End"] == 1 and table["2025-03-12"]["Label des Vacances"] == ""
    limited = {str(r["date"]): r["Jour férié"] for r in cal.calendar(spine, holiday_years=[2025]).collect()}
    assert limited["2026-01-01"] == 0 and limited["2025-01-01"] == 1
    assert cal.calendar(spine).columns == cal.CALENDAR_COLUMNS


def test_two_labels_on_one_day_are_no_summer(spark):
    periods = spark.createDataFrame(
        [("PARIS", "Vacances d'été", dt.date(2025, 7, 1), dt.date(2025, 7, 2)), ("NICE", "Pont", dt.date(2025, 7, 2), dt.date(2025, 7, 2))],
        "city string, label string, start_date date, end_date date",
    )
    flights = spark.createDataFrame([("2025-07-01",), (" 2025-07-02",), ("2025-07-03",), (None,)], "flight_date string")
    got = cal.add_calendar(flights, cal.calendar_for(flights, periods=periods))
    assert rows(got, "flight_date", "Label des Vacances", "is_summer_vacation") == [
        (" 2025-07-02", "Pont, Vacances d'été", 0), ("2025-07-01", "Vacances d'été", 1), ("2025-07-03", "", 0), (None, None, 0),
    ]


def test_strikes(spark):
    at = dt.datetime
    data = [
        ("Grève à Orly", "u1", at(2026, 1, 2, 8), "", "a"), ("GREVE A ORLY", "u1", at(2026, 1, 2, 9), "", "a"),
        ("Encore", "u2", at(2026, 1, 2, 7), "grève &agrave; Orly et Nice", "b"), ("Grève en mer", "u3", at(2026, 1, 2), "", "c"),
        ("Orly", "u4", at(2026, 1, 2), "sans rien", "c"), ("Grève à Orly", "u5", None, "", "c"), ("Strike at Lyon", "u6", at(2026, 1, 4, 1), "", "c"),
    ]
    articles = spark.createDataFrame(data, schemas.ARTICLE.simpleString()[7:-1].replace(":", " "))
    unique = news.unique_articles(news.relevant(articles))
    assert unique.where("airport = 'ORLY'").count() == 2
    table = news.strike_table(cal.day_spine(spark, "2026-01-02", "2026-01-04"), news.daily_titles(unique))
    got = {str(r["date"]): r for r in table.collect()}
    assert got["2026-01-02"]["LABEL_ORLY"] == "Encore | Grève à Orly" and got["2026-01-02"]["GREVE_ORLY"] == "Oui"
    assert got["2026-01-02"]["LABEL_NICE"] == "Encore" and got["2026-01-02"]["GREVE_CDG"] == "Non"
    assert got["2026-01-03"]["GREVE_ORLY"] == "Non" and got["2026-01-04"]["LABEL_LYON"] == "Strike at Lyon"
    flights = spark.createDataFrame([("2026-01-02",), ("2027-01-01",)], "flight_date string")
    assert rows(news.add_strikes(flights, table), "flight_date", "GREVE_ORLY") == [("2026-01-02", "Oui"), ("2027-01-01", None)]
    inside = news.in_window(F.to_date("pub_date"), F.lit("2026-01-03").cast("date"), 1)
    assert articles.where(inside).count() == 5


def test_no_articles_gives_non(spark):
    empty = spark.createDataFrame([], schemas.ARTICLE)
    table = news.strike_table(cal.day_spine(spark, "2026-01-01", "2026-01-02"), news.daily_titles(news.unique_articles(news.relevant(empty))))
    assert rows(table, "GREVE_ORLY", "LABEL_ORLY") == [("Non", ""), ("Non", "")]


# Shaping and profiles ---------------------------------------------------------------------


def test_conform_adds_orders_and_refuses(spark):
    df = spark.createDataFrame([("x", "7")], "source string, title string")
    got = schemas.conform(df, schemas.ARTICLE)
    assert got.columns == schemas.ARTICLE.fieldNames() and got.first()["pub_date"] is None
    with pytest.raises(schemas.MissingColumns):
        schemas.conform(df, schemas.ARTICLE, required=["link"])


def test_shaping(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, ` x ` string, NBVols int")
    assert shp.trimmed_names(df).columns == ["id", "x", "NBVols"]
    assert shp.drop_matching(df).columns == ["id", " x "]
    assert shp.drop_leading(df, 2).columns == ["NBVols"]
    assert shp.suffixed(df, "_dep", keep=["id"]).columns == ["id", " x _dep", "NBVols_dep"]
    assert rows(shp.key_value(shp.trimmed_names(df), ["id"])) == [(1, "NBVols", None), (1, "x", "a")]
    report = shp.key_value_report(shp.trimmed_names(df), "id", "2026-04-16 23:30:18")
    assert rows(report)[:2] == [(1, 0, "DATE_GENERATION", "2026-04-16 23:30:18"), (1, 1, "LineNumber_1", "1")]
    nested = spark.sql("select named_struct('a', 1, 'b', named_struct('c', 'z')) s, array(1) l")
    assert shp.flatten(nested).columns == ["s.a", "s.b.c", "l"]
    assert shp.stack(spark.sql("select 1 a"), spark.sql("select 2 b")).count() == 2
    places = spark.createDataFrame([("ORLY",), ("CDG",), (None,)], "icao string")
    assert rows(shp.recode(places, "icao")) == [("CDG",), ("ORY",), (None,)]


def test_kept_by_name():
    names = ["fog_dep", "airline", "flight_number", "Arrival_DELAY", "status", "retard arrivée"]
    assert shp.kept_by_name(names) == ["fog_dep", "flight_number", "Arrival_DELAY", "status", "retard arrivée"]
    assert shp.kept_by_name(names, extra=()) == ["fog_dep", "flight_number", "Arrival_DELAY", "retard arrivée"]


def test_profiles(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, "Unknown"), (nan, ""), (None, None), (inf, "x")], "a double, b string")
    assert rows(prof.null_profile(df)) == [("a", 50.0), ("b", 25.0)]
    assert tuple(prof.emptiness(df).first()) == (3, 1, 4, 1)
    assert tuple(prof.health(df).first()) == (4, 2, 3)
    assert prof.drop_sparse(df, 0.4).columns == ["b"]
    assert prof.drop_sparse(df, 0.5).columns == ["a", "b"]


def test_purge(spark):
    data = [(1, "A", None, 5, 1.0), (2, None, None, None, None), (3, "C", 7.0, None, 2.0)]
    df = spark.createDataFrame(data, "id int, flight_number string, rare_dep double, arrival_delay_min int, other double")
    got = prof.purge(df, ["id"])
    assert got.columns == ["flight_number", "arrival_delay_min"]
    assert rows(got) == [("A", 5), ("A", 5), ("C", 5)]
    kept = prof.purge(df, ["id"], extra_keep=["other"], fill_target=False)
    assert rows(kept) == [("A", 5, 1.0), ("A", None, 1.0), ("C", None, 2.0)]


# Features ---------------------------------------------------------------------------------


def test_codes(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("b", "x"), ("é", "y")], "c string, d string")
    codes = ft.fit_codes(train, ["c", "d"])
    assert rows(codes) == [("c", "a", 0), ("c", "b", 1), ("c", "é", 2), ("d", "nan", 0), ("d", "x", 1), ("d", "y", 2)]
    new = spark.createDataFrame([("b", "x"), ("zz", None)], "c string, d string")
    assert rows(ft.apply_codes(new, codes, ["c", "d"])) == [(-1.0, 0.0), (1.0, 1.0)]


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_medians_are_exact(spark, limit):
    picker = random.Random(3)
    data = [(picker.gauss(0, 1) if picker.random() < 0.8 else None, picker.randrange(3), 1.5) for _ in range(5001)]
    df = spark.createDataFrame(data, "a double, b int, c double").repartition(4)
    got = ft.medians(df, ["a", "b", "c"], exact_rows=limit).first()
    expected = df.toPandas()[["a", "b", "c"]].median()
    assert got["a"] == pytest.approx(expected["a"], abs=1e-12) and got["b"] == expected["b"] and got["c"] == 1.5
    even = spark.createDataFrame([(float(x),) for x in (9, 1, 4, 4, 2, 7, 8, 3, 6, 0)], "a double")
    assert ft.medians(even, ["a"], exact_rows=2).first()["a"] == 4.0
    two = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    assert ft.medians(two, ["a"], exact_rows=1).first()["a"] == 1.5


def test_impute_and_align(spark):
    df = spark.createDataFrame([(1.0, 2), (float("nan"), None)], "a double, b int")
    assert rows(ft.impute(df, {"a": 9.0, "b": 3.0, "gone": 1.0})) == [(1.0, 2.0), (9.0, 3.0)]
    layout = spark.createDataFrame([], "b double, z double").schema
    assert rows(ft.align(df, layout)) == [(2.0, 0.0), (None, 0.0)]


@pytest.mark.parametrize("by", [None, "label"])
def test_split_is_exact_and_repeatable(spark, by):
    df = spark.range(1003).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    train, test = ft.split(df, ["id"], 0.2, by=by)
    assert train.count() + test.count() == 1003 and train.join(test, "id").isEmpty()
    if by:
        assert rows(test.groupBy("label").count()) == [(0, 161), (1, 41)]
    else:
        assert test.count() == 201
    assert same(ft.split(df.repartition(5), ["id"], 0.2, by=by)[1], test)
    sizes = [r["count"] for r in ft.folds(df, ["id"], 5).groupBy("fold").count().collect()]
    assert sorted(sizes) == [200, 200, 201, 201, 201]


def test_copies_stay_together_in_a_split(spark):
    df = spark.range(300).select(F.when(F.col("id") < 150, 0).otherwise(F.col("id")).alias("id"))
    train, test = ft.split(df, ["id"])
    assert train.count() + test.count() == 300 and train.join(test, "id").isEmpty()


def test_sample(spark):
    df = spark.range(100)
    one = ft.seeded_sample(df, ["id"], 7)
    assert one.count() == 7 and same(one, ft.seeded_sample(df.repartition(3), ["id"], 7))
    assert not same(one, ft.seeded_sample(df, ["id"], 7, seed=1))


def test_date_parts(spark):
    df = spark.createDataFrame(
        [("2026-04-26", "2026-04-26 12:40+02:00", "2026-10-25 02:30+01:00"), (None, "bad", None)],
        "flight_date string, scheduled_departure_dep string, scheduled_arrival_arr string",
    )
    got = ft.date_parts(df)
    assert rows(got) == [(4, 26, 6, 12, 40, 2, 30), (None,) * 7]
    assert ft.date_parts(df.select("flight_date")).columns == ["flight_month", "flight_day", "flight_dayofweek"]
    wide = ft.date_parts_wide(df, ["flight_date", "scheduled_departure_dep"])
    assert wide.first()["scheduled_departure_dep_hour"] == 12 and wide.first()["flight_date_weekday"] == 6


# Metrics and rankings ---------------------------------------------------------------------


def predictions(spark, data):
    return spark.createDataFrame(data, "label int, prediction double, probability double")


def test_metrics_when_nothing_is_predicted(spark):
    df = predictions(spark, [(1, 0.0, 0.1), (0, 0.0, 0.2)])
    assert tuple(mt.class_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    "data,auc",
    [
        ([(0, 0.0, 0.1), (1, 1.0, 0.9)], 1.0),
        ([(0, 0.0, 0.5), (1, 1.0, 0.5)], 0.5),
        ([(0, 0.0, 0.1), (0, 0.0, 0.6), (1, 1.0, 0.6), (1, 1.0, 0.8)], 0.875),
        ([(1, 1.0, 0.5)], None),
    ],
)
@pytest.mark.parametrize("size", [1, 1000])
def test_auc(spark, data, auc, size):
    assert mt.roc_auc(predictions(spark, data), rows_per_slice=size).first()["roc_auc"] == auc


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "label double, prediction double")
    mae, rmse, r2 = mt.regression_metrics(df).first()
    assert (mae, rmse, r2) == (pytest.approx(1.0), pytest.approx((5 / 3) ** 0.5), pytest.approx(1 - 5 / 8))


def test_correlation_of_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0, 0), (2.0, 7.0, 1), (None, 7.0, 1)], "a double, k double, y int")
    assert rows(rk.correlations(df, ["a", "k"], "y"), "raw_feature", "corr_with_target") == [("a", pytest.approx(1.0)), ("k", 0.0)]


@pytest.mark.parametrize(
    "encoded,base",
    [("num__temperature", "temperature"), ("cat__airline_AF", "airline"), ("cat__air_line_x_y", "air_line"), ("cat__gone_x", "gone"), ("plain", "plain")],
)
def test_base_feature(spark, encoded, base):
    df = spark.createDataFrame([(encoded,)], "e string")
    assert df.select(rk.base_feature(F.col("e"), ["air", "airline", "air_line"])).first()[0] == base


# Matching ---------------------------------------------------------------------------------

FLIGHTS = [
    (1, "AF 100", [], "2026-01-01", "CDG", "NCE", "2026-01-01 10:00+01:00"),
    (2, "AF 100", [], "2026-01-01", "CDG", "NCE", "2026-01-01 11:00+01:00"),
    (3, "AF 100", [], "2026-01-01", "ORY", "NCE", "2026-01-01 10:30+01:00"),
    (4, "DL 9", ["af 200"], "2026-01-01", "CDG", "LYS", "2026-01-01 23:55+01:00"),
    (5, "AF 300", None, "2026-01-01", "CDG", "LYS", None),
]
CASES = [
    ("exact", "af100", "2026-01-01T10:00", "CDG - Paris", "NCE", "success", 1, 0),
    ("tie goes to the first", "AF100", "2026-01-01T10:30", "CDG", "NCE", "success", 1, 30),
    ("31 minutes", "AF100", "2026-01-01T11:31", "CDG", "NCE", "error_time_mismatch", None, 31),
    ("no origin agrees", "AF100", "2026-01-01T10:31", "LYS", "NCE", "success", 3, 1),
    ("no destination agrees", "AF100", "2026-01-01T10:59", "CDG", "TLS", "success", 2, 1),
    ("no hour", "AF100", "2026-01-01", "CDG", None, "success", 1, None),
    ("codeshare", "AF200", "2026-01-01T23:50", "CDG", "LYS", "success_with_warning_codeshare", 4, 5),
    ("midnight is not wrapped", "AF200", "2026-01-01T00:05", "CDG", "LYS", "error_time_mismatch", None, 1430),
    ("no readable time", "AF300", "2026-01-01T08:00", "CDG", "LYS", "success", 5, None),
    ("other day", "AF100", "2026-01-02T10:00", "CDG", "NCE", "error_flight_not_found", None, None),
]


def test_match(spark):
    flights = spark.createDataFrame(
        FLIGHTS,
        "place int, flight_number string, codeshares array<string>, flight_date string, airport_origin string,"
        " airport_destination string, scheduled_departure string",
    )
    requests = spark.createDataFrame(
        [c[:5] for c in CASES], "request_id string, flight_number string, date string, departure_airport string, arrival_airport string"
    )
    got = {r["request_id"]: r for r in mat.match(requests, flights, ["place"]).collect()}
    at = {f[0]: f for f in FLIGHTS}
    for name, *_, status, place, gap in CASES:
        row = got[name]
        assert (row["status"], row["best_time_diff_minutes"]) == (status, gap), name
        assert row["matched_scheduled_departure"] == (at[place][6] if place else None), name
    assert got["31 minutes"]["error_code"] == "TIME_MISMATCH" and got["other day"]["error_code"] == "FLIGHT_NOT_FOUND"
    # Copies of flights and of requests change nothing.
    many = requests.unionByName(requests.withColumn("request_id", F.concat(F.lit("again "), "request_id")))
    copies = flights.unionByName(flights.withColumn("place", F.col("place") + 100))
    again = {r["request_id"]: r for r in mat.match(many, copies, ["place"]).collect()}
    assert len(again) == 20 and all(again[n][1:] == got[n][1:] for n in got)


def test_daily_titles_of_a_hot_day_are_joined_over_several_ranges(spark):
    import random

    rng = random.Random(3)
    rows = [(f"t{i:05d}", "2026-01-02", "NICE", f"2026-01-02 {rng.randrange(24):02d}:{rng.randrange(60):02d}:00") for i in range(6000)]
    rows += [("t00001", "2026-01-02", "NICE", "2026-01-01 00:00:00"), ("other", "2026-01-03", "LYON", "2026-01-03 10:00:00")]
    frame = spark.createDataFrame(rows, "title string, day string, airport string, pub_date string").selectExpr(
        "title", "to_date(day) as day", "airport", "to_timestamp(pub_date) as pub_date"
    )
    got = {r["day"].isoformat(): r for r in news.daily_titles(frame, ["NICE", "LYON"], titles_per_part=500).collect()}
    first = {}
    for title, day, airport, at in rows:
        if airport == "NICE" and day == "2026-01-02":
            first[title] = min(first.get(title, at), at)
    want = " | ".join(t for t, _ in sorted(first.items(), key=lambda kv: (kv[1], kv[0])))
    assert got["2026-01-02"]["LABEL_NICE"] == want and got["2026-01-02"]["LABEL_LYON"] == ""
    assert got["2026-01-03"]["LABEL_LYON"] == "other" and got["2026-01-03"]["LABEL_NICE"] == ""


def brute_match(question, flights):
    """The rules of ``match`` by plain loops: level, then nearest minute, then place."""
    number, hour, origin, destination = question
    mine = [f for f in flights if f[1] == number]
    if not mine:
        return None
    level = lambda f: 2 * (f[2] == origin) + (f[3] == destination and destination != "")
    top = max(level(f) for f in mine)
    wanted = None if hour is None else int(hour[:2]) * 60 + int(hour[3:])
    gap = lambda f: None if wanted is None else abs(f[4] - wanted)
    best = min((f for f in mine if level(f) == top), key=lambda f: (gap(f) is None, gap(f) or 0, f[0]))
    return best[0], gap(best)


def test_questions_carry_no_lists_of_flights(spark):
    """Each join of the match takes single values on the question's side, so its size does not follow a day's flights."""
    flights = spark.createDataFrame(
        FLIGHTS,
        "place int, flight_number string, codeshares array<string>, flight_date string, airport_origin string,"
        " airport_destination string, scheduled_departure string",
    )
    requests = spark.createDataFrame(
        [c[:5] for c in CASES], "request_id string, flight_number string, date string, departure_airport string, arrival_airport string"
    )
    joins, todo = [], [mat.match(requests, flights, ["place"])._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        todo += children
        if node.nodeName() == "Join":
            out = children[0].output()
            joins.append([out.apply(i).dataType().typeName() for i in range(out.size())])
    assert len(joins) >= 5 and not any("array" in kinds for kinds in joins)


def test_match_of_a_hot_day_equals_loops(spark):
    rng = random.Random(21)
    ends = ["CDG", "ORY", "NCE", "LYS"]
    flights = [(p, "AF 7", rng.choice(ends), rng.choice(ends), rng.randrange(1440)) for p in range(400)]
    flights += [(400 + p, "AF 8", rng.choice(ends), rng.choice(ends), rng.randrange(1440)) for p in range(5)]
    asked = []
    for i in range(600):
        hour = None if rng.random() < 0.2 else f"{rng.randrange(24):02d}:{rng.randrange(60):02d}"
        asked.append((f"r{i}", rng.choice(["AF 7", "AF 8", "AF 9"]), hour, rng.choice(ends), rng.choice(ends + [""])))
    frame = spark.createDataFrame(
        [(p, n, [], "2026-01-01", a, b, f"2026-01-01 {m // 60:02d}:{m % 60:02d}+01:00") for p, n, a, b, m in flights],
        "place int, flight_number string, codeshares array<string>, flight_date string, airport_origin string,"
        " airport_destination string, scheduled_departure string",
    )
    requests = spark.createDataFrame(
        [(r, n, "2026-01-01" + (f"T{h}" if h else ""), a, b or None) for r, n, h, a, b in asked],
        "request_id string, flight_number string, date string, departure_airport string, arrival_airport string",
    )
    got = {r["request_id"]: r for r in mat.match(requests, frame, ["place"]).collect()}
    by_place = {f[0]: f for f in flights}
    for r, n, h, a, b in asked:
        want = brute_match((n, h, a, b), flights)
        row = got[r]
        if want is None:
            assert row["status"] == "error_flight_not_found", r
            continue
        place, gap = want
        assert row["best_time_diff_minutes"] == gap, r
        if gap is None or gap <= 30:
            m = by_place[place][4]
            assert row["matched_scheduled_departure"] == f"2026-01-01 {m // 60:02d}:{m % 60:02d}+01:00", r
        else:
            assert row["status"] == "error_time_mismatch", r
