"""Missing values, references and stored tables."""

import html
import os
import random

import pytest
from pyspark.sql import functions as F

from skyloom import session
from skyloom.functions import text, values
from skyloom.operators import features as ft
from skyloom.operators.metrics import roc_auc
from skyloom.operators.slices import fill_both_ways
from skyloom.plans.training import fit_encoding
from skyloom.schemas import WEATHER, conform


def test_scratch_drops_what_was_stored_in_it(spark):
    folder = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with session.scratch(spark):
        kept = session.stored(spark.range(5).toDF("x"))
        assert kept.count() == 5 and len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before


def test_references_are_decoded_as_the_standard_says(spark):
    rng = random.Random(3)
    pieces = ["&", "#", "x", ";", "amp", "lt", "eacute", "notit", "128", "55296", "1114112", "0", "41", "CounterClockwiseContourIntegral", " ", "a", "&#X1F600;", "&copy;"]
    cases = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    frame = spark.createDataFrame([(c,) for c in cases], "c string")
    for row in frame.select("c", text.unescape(F.col("c")).alias("plain")).collect():
        assert row["plain"] == html.unescape(row["c"]), row["c"]


def test_nan_is_missing(spark):
    nan = float("nan")
    frame = spark.createDataFrame([(1, nan, "nan"), (2, 4.0, "30"), (3, nan, None), (4, float("inf"), "x")], "k int, v double, t string")
    rows = frame.select("k", values.late_label(F.col("v")).alias("late"), values.late_label(F.col("t")).alias("late_text"), values.flag(F.col("v")).alias("flag")).orderBy("k").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0, 0), (0, 1, 4), (0, 0, 0), (1, 0, 0)]
    filled = fill_both_ways(frame, ["k"], ["v"], rows_per_slice=1).orderBy("k").collect()
    assert [r["v"] for r in filled] == [4.0, 4.0, 4.0, float("inf")]
    weather = conform(spark.createDataFrame([(nan,)], "temperature_2m double"), WEATHER).first()
    assert weather["temperature_2m"] is None


@pytest.mark.parametrize("exact_cell", [ft.EXACT_CELL, 1])
def test_parts_sum_to_the_input(spark, exact_cell):
    rows = spark.range(1000).selectExpr("id", "case when id % 10 > 0 then id % 3 end as stratum")
    train, test = ft.split(rows, ["id"], by="stratum", exact_cell=exact_cell)
    assert train.count() + test.count() == 1000 and test.count() == 200
    assert test.where("stratum is null").count() == 20
    assert ft.folds(rows, ["id"], by="stratum").where("fold is null").count() == 0


def test_other_columns_are_refused(spark):
    frame = spark.sql("select 1 as a, cast(1.5 as decimal(4, 2)) as b, true as c, date'2024-01-01' as d")
    assert ft.number_columns(frame) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="d"):
        fit_encoding(frame, [])


def test_area_of_many_rows_does_not_overflow(spark):
    frame = spark.createDataFrame([(1, 0.9), (0, 0.1)], "label int, probability double")
    assert roc_auc(frame).first()["roc_auc"] == 1.0
