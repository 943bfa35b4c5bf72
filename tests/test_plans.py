"""Whole plans: landed files to the final table, training and scoring, the request stream."""

import json

import pytest
from pyspark.sql import functions as F

from skyloom.operators import features as ft
from skyloom.operators import movements as mov
from skyloom.operators import signoff as sign
from skyloom.operators.distinct import keep_unique
from skyloom.operators.weather import weather_table
from skyloom.plans import history, scoring, training
from skyloom.schemas import BOARD, MOVEMENT, RAW_WEATHER, RECORD_BOARD, conform
from skyloom.sources import articles, boards, files
from skyloom.streaming import requests as stream


def clock(utc, local):
    return {"utc": utc, "local": local}


def reply(number, dep_terminal, arr_terminal, dep, arr, late, to="NCE"):
    """A reply to a single-flight request for a flight still expected."""
    side = {"airport": {"icao": "LFPG", "iata": "CDG", "name": "Paris Charles de Gaulle", "location": {"lat": 49.0128, "lon": 2.549999}}, "scheduledTime": dep, "revisedTime": dep, "terminal": dep_terminal, "quality": ["Basic", "Live"]}
    other = {"airport": {"iata": to, "name": "Côte d'Azur"}, "scheduledTime": arr, "predictedTime": late, "terminal": arr_terminal, "quality": ["Basic"]}
    return {"departure": side, "arrival": other, "number": number, "status": "Expected", "codeshareStatus": "IsOperator", "isCargo": False, "aircraft": {"model": "Airbus A321"}, "airline": {"name": "Air France", "iata": "AF", "icao": "AFR"}}


GOLDEN = [
    (
        reply("AF 7310", "2F", "2", clock("2026-04-23 10:40Z", "2026-04-23 12:40+02:00"), clock("2026-04-23 12:20Z", "2026-04-23 14:20+02:00"), clock("2026-04-23 12:28Z", "2026-04-23 14:28+02:00")),
        {
            "flight_date": "2026-04-23", "movement_date": "2026-04-23", "flight_number": "AF 7310", "airline": "Air France",
            "airport_origin": "CDG", "airport_destination": "NCE", "terminal_departure": "2F", "terminal_arrival": "2",
            "scheduled_departure": "2026-04-23 12:40+02:00", "scheduled_arrival": "2026-04-23 14:20+02:00",
            "estimated_departure": "2026-04-23 12:40+02:00", "estimated_arrival": "2026-04-23 14:20+02:00",
            "actual_departure": None, "actual_arrival": None, "actual_source_departure": None, "actual_source_arrival": None,
            "departure_delay_min": None, "departure_advance_min": None, "arrival_delay_min": None, "arrival_advance_min": None,
            "status": "Expected", "movement_type": "departure", "codeshares": [],
        },
    ),
    (
        reply("AF 7330", "2F", "1", clock("2026-04-25 05:20Z", "2026-04-25 07:20+02:00"), clock("2026-04-25 06:45Z", "2026-04-25 08:45+02:00"), clock("2026-04-25 07:02Z", "2026-04-25 09:02+02:00"), "MRS"),
        {
            "flight_date": "2026-04-25", "movement_date": "2026-04-25", "flight_number": "AF 7330", "airline": "Air France",
            "airport_origin": "CDG", "airport_destination": "MRS", "terminal_departure": "2F", "terminal_arrival": "1",
            "scheduled_departure": "2026-04-25 07:20+02:00", "scheduled_arrival": "2026-04-25 08:45+02:00",
            "estimated_departure": "2026-04-25 07:20+02:00", "estimated_arrival": "2026-04-25 08:45+02:00",
            "actual_departure": None, "actual_arrival": None, "actual_source_departure": None, "actual_source_arrival": None,
            "departure_delay_min": None, "departure_advance_min": None, "arrival_delay_min": None, "arrival_advance_min": None,
            "status": "Expected", "movement_type": "departure", "codeshares": [],
        },
    ),
]


@pytest.mark.parametrize("answer,expected", GOLDEN)
def test_single_flight_reply(spark, tmp_path, answer, expected):
    path = tmp_path / "reply.json"
    # Landed replies start with a byte-order mark.
    path.write_text(json.dumps([answer], ensure_ascii=False, indent=2), encoding="utf-8-sig")
    flights = boards.read_flight_replies(spark, str(path))
    got = mov.departure_records(flights, "CDG").first().asDict()
    assert got == expected


def test_codeshares_come_as_list_or_value(spark, tmp_path):
    lines = [{"number": "A 1", "codeshares": ["B 1", "C 1"]}, {"number": "A 2", "codeshares": "D 2"}, {"number": "A 3"}]
    path = tmp_path / "reply.json"
    path.write_text(json.dumps(lines))
    got = mov.departure_records(boards.read_flight_replies(spark, str(path)), "CDG")
    assert {r["flight_number"]: r["codeshares"] for r in got.collect()} == {"A 1": ["B 1", "C 1"], "A 2": ["D 2"], "A 3": []}


def flight(number, dep, arr, origin, destination, status="Arrived", **times):
    out = {"number": number, "status": status, "airline": {"name": "Air"}, "departure": {"airport": {"iata": origin}, "scheduledTime": {"local": dep}}, "arrival": {"airport": {"iata": destination}, "scheduledTime": {"local": arr}}}
    for key, value in times.items():
        side, name = key.split("_")
        out[side][name] = value if name == "terminal" else {"local": value}
    return out


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Two boards that share a flight, hourly weather, one feed."""
    root = tmp_path_factory.mktemp("landed")
    d, a = "2026-04-23 12:40+02:00", "2026-04-23 14:20+02:00"
    from_cdg = flight("AF 1", d, a, "CDG", "NCE", departure_actualTime="2026-04-23 12:50+02:00", departure_terminal="2F")
    at_nce = flight("AF 1", d, a, "CDG", "NCE", arrival_revisedTime="2026-04-23 14:40+02:00", arrival_terminal="2")
    abroad = flight("AF 9", d, a, "CDG", "JFK")
    ghost = flight("AF 2", "2026-04-24 08:00+02:00", "2026-04-24 09:30+02:00", "ORY", "TLS", status=" Unknown")
    early = flight("AF 3", "2026-04-24 10:00+02:00", "2026-04-24 11:00+02:00", "LYS", "ORY", arrival_actualTime="2026-04-24 10:55+02:00")
    replies = [
        {"queried_airport": "CDG", "slot_start": "2026-04-23T12:00", "departures": [from_cdg, abroad], "arrivals": []},
        {"queried_airport": "NCE", "slot_start": "2026-04-23T12:00", "departures": [], "arrivals": [at_nce]},
        {"queried_airport": "ORY", "slot_start": "2026-04-24T00:00", "departures": [ghost], "arrivals": [early]},
    ]
    (root / "boards.json").write_text("\n".join(json.dumps(r) for r in replies))
    (root / "feed.xml").write_text(
        "<?xml version='1.0'?><rss><channel><item><title>Grève à Nice</title><link>u</link>"
        "<pubDate>Thu, 23 Apr 2026 01:00:00 +0000</pubDate><description>d</description><source url='s'>S</source></item></channel></rss>"
    )
    readings = [("2026-04-23T10:00", "CDG", 1.5, 92.0), ("2026-04-23T12:00", "NICE", 18.0, 40.0)]
    raw = spark.createDataFrame(readings, "time string, icao string, temperature_2m double, relative_humidity_2m double")
    return root, weather_table(conform(raw, RAW_WEATHER))


def test_history(spark, landed):
    root, weather = landed
    board = boards.read_boards(spark, str(root / "boards.json"))
    flights = mov.movement_table(board)
    assert sorted(r["flight_number"] for r in flights.collect()) == ["AF 1", "AF 2", "AF 3"]
    rules = history.Rules(trim_head=0, trim_tail=0)
    table = history.flight_history(board, weather, articles.read_feeds(spark, str(root / "feed.xml")), "2026-04-20", "2026-04-30", rules)
    got = {r["flight_number"]: r.asDict() for r in table.collect()}
    one = got["AF 1"]
    assert (one["terminal_departure"], one["terminal_arrival"]) == ("2F", "2")
    assert (one["departure_delay_min"], one["arrival_delay_min"], one["actual_source_arrival"]) == (10, 20, "revisedTime")
    assert one[sign.LABEL] == 1 and one["movement_type"] == "departure"
    assert (one["icing_conditions_dep"], one["temperature_2m_arr"]) == ("Oui", 18.0)
    assert (one["GREVE_NICE"], one["LABEL_NICE"], one["GREVE_ORLY"]) == ("Oui", "Grève à Nice", "Non")
    assert one["Label des Vacances"] == "Vacances de printemps" and one["is_summer_vacation"] == 0
    assert (one["nombre_departs_source"], one["nombre_arrivees_destination"]) == (2, 1)
    assert got["AF 3"]["arrival_advance_min"] == 5 and got["AF 3"][sign.LABEL] == 0
    assert got["AF 2"]["congestion_destination"] == 0
    shares = sign.indicators(table).first()
    assert shares["flights"] == 3 and shares["pct_unknown_status"] == pytest.approx(100 / 3)
    assert sign.finish(table).count() == 2
    assert len(table.columns) == len(MOVEMENT) + 1 + 42 + 10 + 1 + 12 + 8 + 1


def test_history_makes_records_on_target_routes_only(spark, landed, monkeypatch):
    root, weather = landed
    kept = []
    monkeypatch.setattr(history, "stored", lambda df: kept.append(df) or df)
    news = articles.read_feeds(spark, str(root / "feed.xml"))
    tables = [
        history.flight_history(boards.read_boards(spark, str(root / "boards.json"), layout), weather, news, "2026-04-20", "2026-04-30", history.Rules(trim_head=0, trim_tail=0))
        for layout in (BOARD, RECORD_BOARD)
    ]
    rows = [sorted(map(repr, t.collect())) for t in tables]
    assert rows[0] == rows[1] and len(rows[0]) == 3
    # All flights seen are stored, without what only the target routes' records need.
    assert kept[1].count() == 5 and not {c for c in kept[1].columns if "delay" in c or "estimated" in c}
    full, narrow = (mov.records(mov.board_flights(boards.read_boards(spark, str(root / "boards.json"), layout))) for layout in (BOARD, RECORD_BOARD))
    assert full.dtypes == narrow.dtypes and sorted(map(repr, full.collect())) == sorted(map(repr, narrow.collect()))
    assert full.columns[: len(MOVEMENT)] == MOVEMENT.fieldNames()


def test_joins_keep_the_row_count(spark, landed):
    root, weather = landed
    flights = mov.movement_table(boards.read_boards(spark, str(root / "boards.json")))
    days = history.cal.calendar(history.cal.day_spine(spark, "2026-04-01", "2026-04-30"))
    news = history.strikes_of(articles.read_feeds(spark, str(root / "feed.xml")), "2026-04-01", "2026-04-30")
    assert history.enriched(flights, weather, days, news).count() == flights.count()


# Files ------------------------------------------------------------------------------------


def test_csv_mark_blanks_and_empty(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(" id ; name\n1;  x \n2;\n", encoding="utf-8-sig")
    got = files.read_csv(spark, str(path), sep=";", trim=True)
    assert got.columns == ["id", "name"] and [tuple(r) for r in got.collect()] == [("1", "x"), ("2", None)]


def test_empty_table_is_an_error(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    with pytest.raises(files.EmptyTable):
        files.read_table(spark, str(tmp_path / "t"))


def test_latest_file(spark, tmp_path):
    import os

    for i, name in enumerate(["b.csv", "c.csv", "a.csv"]):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    assert files.latest_file(spark, str(tmp_path)).endswith("a.csv")
    assert files.latest_file(spark, str(tmp_path), by="name").endswith("c.csv")
    assert files.latest_file(spark, str(tmp_path), "*.parquet") is None


def test_layer_rerun_replaces_its_own_partition(spark, tmp_path):
    root = str(tmp_path)
    files.write_layer(spark.range(3), root, "raw", "2026-04-20")
    files.write_layer(spark.range(5), root, "raw", "2026-04-21")
    files.write_layer(spark.range(1), root, "raw", "2026-04-21")
    counts = {str(r["run_date"]): r["count"] for r in files.read_layer(spark, root, "raw").groupBy("run_date").count().collect()}
    assert counts == {"2026-04-20": 3, "2026-04-21": 1}
    pruned = files.read_layer(spark, root, "raw", "2026-04-20")
    assert "PartitionFilters: [isnotnull(run_date" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        files.write_layer(spark.range(1), root, "other", "2026-04-21")


# Training and scoring ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def history_table(spark):
    """Six hundred flights whose delay follows the wind and the airline's hour."""
    return spark.range(600).selectExpr(
        "concat('AF ', id) as flight_number", "date_format(date_add(date'2026-01-01', cast(id % 90 as int)), 'yyyy-MM-dd') as flight_date",
        "element_at(array('CDG', 'ORY'), cast(id % 2 + 1 as int)) as airport_origin", "element_at(array('NCE', 'TLS', 'LYS'), cast(id % 3 + 1 as int)) as airport_destination",
        "concat('2026-01-01 ', lpad(id % 24, 2, '0'), ':30+01:00') as scheduled_departure_dep",
        "case when id % 11 > 0 then cast(id * 37 % 50 as double) end as wind_dep", "case when id % 10 = 0 then 1.0D end as rare_arr",
        "'x' as airline", "cast(id * 37 % 50 - 10 as int) as arrival_delay_min", "cast(0 as int) as departure_delay_min", "0 as `retard arrivée`",
    )


def test_training_table(spark, history_table):
    twice = history_table.unionByName(history_table.limit(10))
    table = ft.training_table(twice)
    assert table.count() == keep_unique(twice, list(ft.FLIGHT_KEYS)).count() == 590
    assert ft.TARGET in table.columns and "retard arrivée" not in table.columns
    assert "rare_arr" not in table.columns and "airline" not in table.columns
    assert table.where("wind_dep is null").isEmpty()
    assert table.where(f"({ft.TARGET} = 1) <> (arrival_delay_min > 15)").isEmpty()
    x = ft.model_input(table)
    assert {"flight_month", "flight_day", "flight_dayofweek", "sched_dep_hour", "sched_dep_minute"} < set(x.columns)
    assert not {"arrival_delay_min", "departure_delay_min", "flight_date"} & set(x.columns)
    assert "arrival_delay_min" in ft.model_input(table, "arrival_delay_min").columns


def test_fit_save_score(spark, history_table, tmp_path):
    x = ft.model_input(ft.training_table(history_table))
    train, test = ft.split(x, ["flight_number"], by=ft.TARGET)
    encoding = training.fit_encoding(train, [ft.TARGET])
    assert "airport_origin" in encoding.categories and "wind_dep" in encoding.numbers
    learner = training.boosted_classifier(maxIter=5, maxDepth=3)
    ready = encoding.apply(train)
    model = training.assembled(learner, encoding.features).fit(ready)
    quality = training.quality(training.scored(model, encoding.apply(test), ft.TARGET)).first()
    assert quality["accuracy"] > 0.8 and 0 <= quality["roc_auc"] <= 1
    training.save_encoding(encoding, str(tmp_path / "encoding"))
    again = training.load_encoding(spark, str(tmp_path / "encoding"))
    assert again.features == encoding.features and again.medians == encoding.medians
    y = ft.model_input(ft.training_table(history_table), "arrival_delay_min")
    reg_encoding = training.fit_encoding(y, ["arrival_delay_min"])
    regressor = training.assembled(training.boosted_regressor(maxIter=5, maxDepth=3), reg_encoding.features).fit(reg_encoding.apply(y))
    new = history_table.limit(20).withColumn("airport_origin", F.lit("XXX"))
    base = scoring.overlay(new.drop("wind_dep"), history_table.where("flight_number = 'AF 1'"))
    assert base.columns == history_table.columns
    scores = scoring.predictions(base.drop("arrival_delay_min", "retard arrivée"), ["flight_number"], model, again, regressor, reg_encoding)
    row = scores.first()
    assert scores.count() == 20 and 0 <= row["delay_probability"] <= 1 and row["predicted_arrival_delay_minutes"] >= 0
    assert row["risk"] in ("low", "medium", "high")
    ranked = training.importances(model, encoding.features).orderBy(F.desc("importance")).first()
    assert ranked["encoded_feature"] == "wind_dep"


def test_search_draws_are_distinct_and_repeatable():
    one = training.draws(training.CLASSIFIER_SPACE, 20, 42)
    assert one == training.draws(training.CLASSIFIER_SPACE, 20, 42) and len({str(d) for d in one}) == 20
    assert len(training.draws({"a": [1, 2]}, 20, 42)) == 2


def test_search_and_folds(spark, history_table):
    x = ft.model_input(ft.training_table(history_table))
    encoding = training.fit_encoding(x, [ft.TARGET])
    ready = encoding.apply(x).withColumn("id", F.monotonically_increasing_id())
    space = {"maxIter": [1, 2], "maxDepth": [2]}
    model, table = training.search(ready, encoding.features, training.boosted_classifier(), ["id"], space, count=2, fold_count=2)
    assert table.count() == 2 and model.transform(ready).count() == ready.count()
    spread = training.mt.across_folds(
        training.fold_metrics(ready, encoding.features, training.boosted_classifier(maxIter=1, maxDepth=2), ["id"], 2), ["accuracy", "roc_auc"]
    )
    assert {r["metric"] for r in spread.collect()} == {"accuracy", "roc_auc"}


def brute_fold_report(rows):
    """Per-fold metrics by plain loops, then their mean and population deviation."""
    import statistics

    per = {}
    for fold in sorted({r[0] for r in rows}):
        part = [r for r in rows if r[0] == fold]
        tp = sum(1 for _, y, p, _s in part if y == 1 and p == 1)
        fp = sum(1 for _, y, p, _s in part if y == 0 and p == 1)
        fn = sum(1 for _, y, p, _s in part if y == 1 and p == 0)
        pos = [s for _, y, _p, s in part if y == 1]
        neg = [s for _, y, _p, s in part if y == 0]
        won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        per[fold] = {
            "accuracy": sum(1 for _, y, p, _s in part if y == p) / len(part), "precision": tp / (tp + fp), "recall": tp / (tp + fn),
            "f1": 2 * tp / (2 * tp + fp + fn), "roc_auc": won / (len(pos) * len(neg)),
        }
    return {m: (statistics.fmean(v[m] for v in per.values()), statistics.pstdev(v[m] for v in per.values())) for m in training.FOLD_METRICS}


def test_fold_report_equals_loops(spark):
    import random

    rng = random.Random(9)
    rows = [(f, y, int(s > 0.5), s) for f in range(3) for y, s in ((rng.random() < 0.4, round(rng.random(), 1)) for _ in range(80))]
    rows = [(f, int(y), float(p), s) for f, y, p, s in rows]
    frame = spark.createDataFrame(rows, "fold int, label int, prediction double, probability double")
    got = {r["metric"]: (r["mean"], r["std"]) for r in training.fold_report(frame).collect()}
    want = brute_fold_report(rows)
    assert got.keys() == want.keys()
    for m in want:
        assert got[m] == pytest.approx(want[m], abs=1e-12)


def test_prepared_folds_and_bins_are_stored_once(spark):
    rows = spark.range(400).selectExpr("cast(id as string) as k", "cast(id % 7 = 0 as int) as y", "cast(id as double) as a", "cast(id % 3 as double) as b")
    prepared = training.prepare(rows, ["a", "b"], ["k"], "y", fold_count=4, bins=8)
    assert prepared.columns == ["k", "y", "fold", "features"]
    got = prepared.collect()
    assert len(got) == 400 and {r["fold"] for r in got} == {0, 1, 2, 3}
    assert max(r["features"][0] for r in got) <= 8 and len({r["features"][1] for r in got}) == 3
    pairs = sorted({(int(r["k"]) % 3, r["features"][1]) for r in got})
    assert [b for _, b in pairs] == sorted(b for _, b in pairs)  # bins keep the order of values
    sizes = prepared.groupBy("fold", "y").count().collect()
    assert max(r["count"] for r in sizes if r["y"] == 1) - min(r["count"] for r in sizes if r["y"] == 1) <= 1
    model, table = training.search_prepared(prepared, training.boosted_classifier(label="y"), {"maxIter": [1, 2], "maxDepth": [2]}, count=2)
    assert table.count() == 2 and table.where("chosen").count() == 1
    predictions = training.out_of_fold(prepared, training.boosted_classifier(label="y", maxIter=2, maxDepth=2), ["k"])
    assert predictions.count() == 400 and predictions.select("k").distinct().count() == 400


def _long_table(spark, times):
    """Sixty different rows of two features, each ``times`` times."""
    return spark.range(60 * times).selectExpr(
        "id", "cast(id % 60 % 10 as double) as a", "cast(id % 6 as double) as b", "cast(id % 10 >= 5 and id % 6 < 3 as int) as y", "cast(id % 60 as double) as z"
    )


def test_cells_do_not_grow_with_the_table(spark):
    learner = training.boosted_classifier(label="y", maxIter=2, maxDepth=2)
    for times in (1, 20):
        cells = training.weighted_cells(_long_table(spark, times), ["a", "b"], learner)
        assert cells.count() == 30 and cells.agg(F.sum(training.WEIGHT)).first()[0] == 60 * times
    # A cell keeps as many rows as a node's minimum asks for, and no more than it has.
    assert training.weighted_cells(_long_table(spark, 2), ["a", "b"], learner, 3).count() == 30 * 3
    assert training.weighted_cells(_long_table(spark, 2), ["id"], learner, 3).count() == 120
    means = training.weighted_cells(_long_table(spark, 1), ["b"], training.boosted_regressor("z"), by_label=False).orderBy("b").collect()
    assert [(r["z"], r[training.WEIGHT]) for r in means] == [(27.0 + b, 10.0) for b in range(6)]


def test_missing_labels_stay_missing_in_cells(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, None), (2.0, 3.0)], "a double, z double")
    got = training.weighted_cells(rows, ["a"], training.boosted_regressor("z"), by_label=False).orderBy("a").collect()
    assert [r["z"] for r in got] == [None, 3.0]


def test_models_are_fitted_on_cells(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(training.GBTClassifier, "fit", lambda self, df, fit=training.GBTClassifier.fit: seen.append(df.count()) or fit(self, df))
    table = _long_table(spark, 20)
    learner = training.boosted_classifier(label="y", maxIter=2, maxDepth=2)
    model = training.assembled(learner, ["a", "b"]).fit(table)
    assert model.transform(table).where("prediction != y").count() == 0
    prepared = training.prepare(table.withColumn("k", F.col("id").cast("string")), ["a", "b"], ["k"], "y", fold_count=2)
    assert training.out_of_fold(prepared, learner, ["k"]).where("prediction = label").count() == 1200
    assert len(seen) == 3 and max(seen) <= 30


def test_bins_of_few_and_many_values(spark):
    rows = spark.range(3200).selectExpr("cast(id % 3 as double) as few", "cast(id as double) as many", "cast(null as double) as none", "double(7) as one")
    few, many, none, one = training.bin_edges(rows, ["few", "many", "none", "one"])
    assert few == [0.5, 1.5] and len(many) == 31 and many == sorted(set(many))
    assert len(none) == len(one) == 1


def test_answered_rows_take_the_first_of_equal_flights(spark):
    answers = spark.createDataFrame(
        [("a", "F1", None, "CDG", "NCE"), ("b", "F9", "t", "CDG", "NCE"), ("c", None, None, None, None)],
        "request_id string, matched_flight_number string, matched_scheduled_departure string, matched_departure_airport string, matched_arrival_airport string",
    )
    flights = spark.createDataFrame(
        [(2, "F1", None, "CDG", "NCE"), (1, "F1", None, "CDG", "NCE"), (0, "F1", "t", "CDG", "NCE"), (3, None, None, None, None)],
        "place int, flight_number string, scheduled_departure string, airport_origin string, airport_destination string",
    )
    found = scoring.answered_rows(answers, flights, ["place"])
    assert sorted((r["request_id"], r["place"]) for r in found.collect()) == [("a", 1), ("b", None), ("c", None)]
    # Flights that answer nothing are left out before the ranking.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Window") < plan.index("LeftSemi")


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], f"{ft.TARGET} int")
    got = training.balanced(df).groupBy(ft.TARGET).agg(F.round(F.sum("weight"), 9).alias("w"))
    assert sorted(r["w"] for r in got.collect()) == [2.0, 2.0]


# Stream -----------------------------------------------------------------------------------


def test_stream_answers_each_request_once(spark, tmp_path):
    flights = spark.createDataFrame(
        [(1, "AF 1", "2026-01-01", "CDG", "NCE", "2026-01-01 10:00+01:00")],
        "place int, flight_number string, flight_date string, airport_origin string, airport_destination string, scheduled_departure string",
    )
    inbox, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    inbox.mkdir()

    def ask(name, *ids):
        lines = [
            {"request_id": i, "flight_number": "AF1", "date": "2026-01-01T10:05", "departure_airport": "CDG", "arrival_airport": "NCE", "asked_at": "2026-01-01T09:00:00"}
            for i in ids
        ]
        (inbox / name).write_text("\n".join(json.dumps(line) for line in lines))

    def run(score=None):
        stream.answer_stream(
            stream.read_requests(spark, str(inbox)), flights, ["place"], str(out), str(state), score
        ).awaitTermination()
        return sorted(r["request_id"] for r in stream.read_answers(spark, str(out)).collect())

    ask("1.json", "a", "b", "a")
    assert run() == ["a", "b"]
    ask("2.json", "b", "c")
    assert run(lambda answers: answers.withColumn("seen", F.lit(True))) == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]


NO_TWIN = {"fit_classifier", "fit_forest_classifier", "fit_forest_regressor", "fit_regressor", "model_importance"}


def test_registered_queries_have_twins():
    import __spark_entry__ as entry
    from skyloom import checks

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(checks.QUERIES) - set(checks.SQL) == NO_TWIN
    assert len(entry.queries()) > 70


def test_a_restarted_stream_takes_candidates_laid_out_before(spark, tmp_path, monkeypatch):
    flights = spark.createDataFrame(
        [(1, "AF 1", "2026-01-01", "CDG", "NCE", "2026-01-01 10:00+01:00")],
        "place int, flight_number string, flight_date string, airport_origin string, airport_destination string, scheduled_departure string",
    )
    offered = stream.prepared(flights, ["place"])
    monkeypatch.setattr(stream, "prepared", lambda *_: pytest.fail("laid out again"))
    inbox, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    inbox.mkdir()
    for name in ("a", "b"):
        line = {"request_id": name, "flight_number": "AF1", "date": "2026-01-01T10:05", "departure_airport": "CDG", "arrival_airport": "NCE", "asked_at": "2026-01-01T09:00:00"}
        (inbox / f"{name}.json").write_text(json.dumps(line))
        stream.answer_stream(stream.read_requests(spark, str(inbox)), flights, ["place"], str(out), str(state), offered=offered).awaitTermination()
    found = stream.read_answers(spark, str(out)).collect()
    assert sorted((r["request_id"], r["status"]) for r in found) == [("a", "success"), ("b", "success")]


def test_unanswered_requests_do_not_meet_in_one_task(spark):
    texts = "request_id string, matched_flight_number string, matched_scheduled_departure string, matched_departure_airport string, matched_arrival_airport string"
    data = [(f"r{i}", "F1" if i == 0 else None, "t" if i < 2 else None, "CDG" if i == 0 else None, None) for i in range(400)]
    answers = spark.createDataFrame(data, texts).repartition(4)
    flights = spark.createDataFrame(
        [(1, "F1", "t", "CDG", None), (2, None, None, None, None)],
        "place int, flight_number string, scheduled_departure string, airport_origin string, airport_destination string",
    )
    kept = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = scoring.answered_rows(answers, flights, ["place"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sorted(r["request_id"] for r in found) == sorted(r[0] for r in data)
    assert [(r["request_id"], r["place"]) for r in found if r["place"] is not None] == [("r0", 1)]
    assert max(sum(1 for r in found if r["task"] == k) for k in {r["task"] for r in found}) < 200


def test_small_batches_are_planned_for_their_size(spark, tmp_path):
    flights = spark.createDataFrame(
        [(1, "AF 1", "2026-01-01", "CDG", "NCE", "2026-01-01 10:00+01:00")],
        "place int, flight_number string, flight_date string, airport_origin string, airport_destination string, scheduled_departure string",
    )
    inbox, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    inbox.mkdir()
    line = {"request_id": "a", "flight_number": "AF1", "date": "2026-01-01T10:05", "departure_airport": "CDG", "arrival_airport": "NCE", "asked_at": "2026-01-01T09:00:00"}
    (inbox / "a.json").write_text(json.dumps(line))
    adaptive = []

    def score(answers):
        adaptive.append(answers.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return answers

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        stream.answer_stream(stream.read_requests(spark, str(inbox)), flights, ["place"], str(out), str(state), score).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["status"] for r in stream.read_answers(spark, str(out)).collect()] == ["success"]
    assert set(adaptive) == {"true"}
    parts = [p for p in (state / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(parts) == max(stream.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
