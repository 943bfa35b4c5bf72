"""Requests matched to the flight table and scored by both models, a whole table at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from skyloom.functions.values import not_negative, risk_band
from skyloom.operators.distinct import keep_first
from skyloom.operators.features import date_parts
from skyloom.operators.lookup import sized
from skyloom.plans.training import Encoding

MATCHED = ["flight_number", "scheduled_departure", "airport_origin", "airport_destination"]
MATCHED_AS = [
    "matched_flight_number", "matched_scheduled_departure", "matched_departure_airport", "matched_arrival_airport",
]


def overlay(df: DataFrame, reference: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of a one-row reference table: known ones from ``df``, the others from that row."""
    base = reference.first()
    kinds = {f.name: f.dataType for f in reference.schema.fields}
    return df.select(
        *keep,
        *[
            (F.col(f"`{c}`") if c in df.columns else F.lit(base[c])).cast(kinds[c]).alias(c)
            for c in reference.columns
            if c not in keep
        ],
    )


def answered_rows(answers: DataFrame, flights: DataFrame, order: list[str]) -> DataFrame:
    """Each answered request with the row of its flight; unanswered ones carry nulls.

    ``answers`` are read three times. Only flights that answer a request are ranked and moved; unanswered requests, whose
    keys are all null and would meet in one task, pass the join by.
    """
    known = F.col("matched_flight_number").isNotNull()
    found = answers.where(known).select(*MATCHED_AS).distinct()
    same = F.lit(True)
    for mine, theirs in zip(MATCHED_AS, MATCHED):
        same = same & F.col(f"`{theirs}`").eqNullSafe(F.col(mine))
    flights = flights.join(sized(found), same, "left_semi")
    first = keep_first(flights, MATCHED, [F.col(c).asc_nulls_last() for c in order])
    renamed = first.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in flights.columns])
    test = F.lit(True)
    for mine, theirs in zip(MATCHED_AS, MATCHED):
        test = test & F.col(mine).eqNullSafe(F.col(f"__{theirs}"))
    joined = answers.where(known).join(renamed, test, "left")
    answered = joined.select(*answers.columns, *[F.col(f"__{c}").alias(c) for c in flights.columns])
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in flights.schema.fields]
    return answered.union(answers.where(~known).select(*answers.columns, *nothing))


def predictions(
    df: DataFrame,
    row_id: Sequence[str],
    classifier: PipelineModel,
    classifier_encoding: Encoding,
    regressor: PipelineModel,
    regressor_encoding: Encoding,
    matched: str | None = None,
) -> DataFrame:
    """Delay probability, late flag, minutes (not negative) and risk band of each row.

    A missing category is empty text here, which no training row holds. Where the boolean column ``matched`` is not true there is no flight
    to score, and all results are null.
    """
    source = date_parts(df) if "flight_date" in df.columns else df
    known = F.lit(True) if matched is None else F.coalesce(F.col(matched), F.lit(False))
    source = source.withColumn("__matched", known)
    # The raw row travels along, so the second encoding needs no join back.
    carried = source.withColumn("__raw", F.struct(*[F.col(f"`{c}`") for c in source.columns]))
    first = classifier.transform(classifier_encoding.apply(carried, "")).select(
        vector_to_array("probability")[1].alias("delay_probability"),
        (F.col("prediction") == 1).alias("is_delayed"),
        "__raw.*",
    )
    second = regressor.transform(regressor_encoding.apply(first, ""))
    scored = second.select(
        *row_id,
        "__matched",
        "delay_probability",
        not_negative(F.col("prediction")).alias("predicted_arrival_delay_minutes"),
        "is_delayed",
    ).withColumn("risk", risk_band(F.col("predicted_arrival_delay_minutes")))
    results = [c for c in scored.columns if c not in (*row_id, "__matched")]
    return scored.select(*row_id, *[F.when(F.col("__matched"), F.col(c)).alias(c) for c in results])
