"""Fitting, searching and storing delay models."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Bucketizer, QuantileDiscretizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyloom.operators import features as ft
from skyloom.operators import metrics as mt
from skyloom.session import stored

# Search spaces in terms of the Spark learners' parameters.
CLASSIFIER_SPACE = {
    "maxIter": [200, 300, 400, 500],
    "stepSize": [0.03, 0.05, 0.08, 0.1],
    "maxDepth": [3, 4, 5, 6],
    "minInstancesPerNode": [1, 3, 5, 7],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "minInfoGain": [0.0, 0.1, 0.3, 0.5],
}
REGRESSOR_SPACE = {
    "maxIter": [200, 300, 500, 700],
    "stepSize": [0.01, 0.03, 0.05, 0.1],
    "maxDepth": [3, 4, 5, 6, 8],
    "minInstancesPerNode": [1, 3, 5, 7],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.6", "0.8", "1.0"],
    "minInfoGain": [0.0, 0.1, 0.3, 0.5],
}


@dataclass(frozen=True)
class Encoding:
    """What preparing a table needs to know from the training rows."""

    categories: list[str]
    numbers: list[str]
    codes: DataFrame
    medians: dict[str, float | None]

    @property
    def features(self) -> list[str]:
        return [*self.categories, *self.numbers]

    def apply(self, df: DataFrame, missing: str | None = None) -> DataFrame:
        """Codes for categories, medians for missing numbers; absent columns read as missing.

        ``missing`` is the text a missing category stands for; without it, the training rows' own category of missing values.
        """
        absent = {c: F.lit(None).cast("string") for c in self.categories if c not in df.columns}
        absent |= {c: F.lit(None).cast("double") for c in self.numbers if c not in df.columns}
        whole = df.withColumns(absent)
        if missing is not None:
            whole = whole.fillna(missing, subset=self.categories)
        coded = ft.apply_codes(whole, self.codes, self.categories) if self.categories else whole
        return ft.impute(coded, self.medians)


def fit_encoding(train: DataFrame, ignore: Sequence[str]) -> Encoding:
    used = [c for c in train.columns if c not in ignore]
    part = train.select(*[F.col(f"`{c}`") for c in used])
    ft.refuse_other_columns(part)
    categories, numbers = ft.text_columns(part), ft.number_columns(part)
    middle = ft.medians(part, numbers).first().asDict() if numbers else {}
    codes = (
        ft.fit_codes(part, categories)
        if categories
        else train.sparkSession.createDataFrame([], "column string, value string, code int")
    )
    return Encoding(categories, numbers, codes, middle)


def save_encoding(encoding: Encoding, path: str) -> None:
    spark = encoding.codes.sparkSession
    encoding.codes.write.mode("overwrite").parquet(f"{path}/codes")
    rows = [(i, c, "category", None) for i, c in enumerate(encoding.categories)]
    rows += [(i, c, "number", encoding.medians.get(c)) for i, c in enumerate(encoding.numbers)]
    spark.createDataFrame(rows, "place int, name string, kind string, median double").write.mode(
        "overwrite"
    ).parquet(f"{path}/columns")


def load_encoding(spark: SparkSession, path: str) -> Encoding:
    # One row per model column.
    columns = spark.read.schema("place int, name string, kind string, median double").parquet(f"{path}/columns")
    rows = sorted(columns.collect(), key=lambda r: r["place"])
    return Encoding(
        [r["name"] for r in rows if r["kind"] == "category"],
        [r["name"] for r in rows if r["kind"] == "number"],
        spark.read.parquet(f"{path}/codes"),
        {r["name"]: r["median"] for r in rows if r["kind"] == "number"},
    )


BINS = 32  # the learners' own maxBins
GRID = 1024
ROWS_PER_TASK = 50_000
WEIGHT = "__weight"


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Inner bin limits of each feature, from one pass over all rows.

    Up to ``bins`` values are kept apart, more are cut at their quantiles; a limit lies midway between two values, as
    the learners' own thresholds do.
    """
    numbers = [F.col(f"`{c}`").cast("double") for c in features]
    grid = [i / GRID for i in range(GRID + 1)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), grid, 10_000).alias(f"q_{i}") for i, x in enumerate(numbers)]).first()
    out = []
    for quantiles in row:
        quantiles = quantiles or [0.0]
        values = sorted(set(quantiles))
        lower = range(len(values) - 1)
        if len(values) > bins:
            at = {v: i for i, v in enumerate(values)}
            lower = sorted({at[quantiles[i * GRID // bins]] for i in range(1, bins)} - {len(values) - 1})
        middle = [(values[i], values[i] / 2 + values[i + 1] / 2, values[i + 1]) for i in lower]
        limits = sorted({m if a < m else b for a, m, b in middle if math.isfinite(m)})
        out.append(limits or [values[0] if math.isfinite(values[0]) else 0.0])
    return out


def weighted_cells(df: DataFrame, by: Sequence[str], learner, parts: int = 1, by_label: bool = True) -> DataFrame:
    """Rows with equal ``by`` (binned features) and label as at most ``parts`` weighted rows; stored.

    A tree learner sees bins only, so this is the same training set, with at most bins ** features x labels x parts rows
    however long the table grows. A cell of n rows becomes min(n, parts) rows: with ``parts`` of
    at least ``minInstancesPerNode`` that minimum decides as on single rows. Without ``by_label`` a cell carries its mean label, which is all that squared errors depend on.
    A missing label stays missing. The rows are sorted, so that a learner that draws rows draws the same ones again.
    """
    label = learner.getLabelCol()
    given = F.col(learner.getWeightCol()) if learner.isSet("weightCol") else F.lit(1.0)
    y = F.col(label)
    sizes = [F.sum(given).alias(WEIGHT), F.count(F.lit(1)).alias("__rows")]
    if by_label:
        grouped = df.groupBy(*by, label).agg(*sizes)
    else:
        mean = F.try_divide(F.sum(given * y.cast("double")), F.sum(given))
        grouped = df.groupBy(*by).agg(F.when(F.count(y) == F.count(F.lit(1)), mean).alias(label), *sizes)
    kept = stored(grouped)
    pieces = F.least(F.col("__rows"), F.lit(parts).cast("long"))
    spread = kept.withColumn(WEIGHT, F.col(WEIGHT) / pieces).withColumn("__piece", F.explode(F.sequence(F.lit(1).cast("long"), pieces)))
    tasks = max(1, math.ceil(kept.count() * parts / ROWS_PER_TASK))
    return stored(spread.drop("__rows").repartition(tasks, *by).sortWithinPartitions(*by, label, "__piece"))


def _pieces(learner, least: int = 1) -> int:
    """Rows a cell needs: the minimum a node must hold, and two at least where the learner draws rows."""
    draws_rows = learner.hasParam("numTrees") or learner.getSubsamplingRate() < 1
    return max(least, learner.getMinInstancesPerNode(), 2 if draws_rows else 1)


def _by_label(learner) -> bool:
    """Whether the labels of a cell must be told apart: squared errors of a regressor need their mean only."""
    squared = not learner.hasParam("lossType") or learner.getLossType() == "squared"
    return learner.hasParam("rawPredictionCol") or not squared


@dataclass(frozen=True)
class Assembled:
    """A tree learner and its features; ``fit`` bins them, reduces the rows to weighted cells and fits on those."""

    learner: Any
    features: list[str]

    def fit(self, train: DataFrame) -> PipelineModel:
        names = [f"__bin_{i}" for i in range(len(self.features))]
        splits = [[-math.inf, *limits, math.inf] for limits in bin_edges(train, self.features)]
        bins = Bucketizer(inputCols=self.features, outputCols=names, splitsArray=splits, handleInvalid="keep")
        vectors = VectorAssembler(inputCols=names, outputCol="features")
        cells = weighted_cells(bins.transform(train), names, self.learner, _pieces(self.learner), _by_label(self.learner))
        weighed = self.learner.copy({self.learner.weightCol: WEIGHT})
        return PipelineModel(stages=[bins, vectors, weighed.fit(vectors.transform(cells))])


def assembled(learner, features: Sequence[str]) -> Assembled:
    return Assembled(learner, list(features))


def boosted_classifier(label: str = ft.TARGET, seed: int = 42, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, seed=seed, **params)


def boosted_regressor(label: str = "arrival_delay_min", seed: int = 42, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, seed=seed, **params)


def forest_classifier(label: str = ft.TARGET, seed: int = 42, **params) -> RandomForestClassifier:
    """Random forest on rows weighted by ``balanced``."""
    defaults = {"numTrees": 200, "minInstancesPerNode": 2}
    return RandomForestClassifier(labelCol=label, weightCol="weight", seed=seed, **{**defaults, **params})


def forest_regressor(label: str = "arrival_delay_min", seed: int = 42, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, seed=seed, **{"numTrees": 200, "minInstancesPerNode": 2, **params})


def balanced(df: DataFrame, label: str = ft.TARGET) -> DataFrame:
    """Add ``weight`` so that every class weighs the same in total."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    total = sum(r["n"] for r in sizes)
    weight = None
    for r in sizes:
        hit = F.col(label) == r[label]
        value = total / (len(sizes) * r["n"])
        weight = F.when(hit, value) if weight is None else weight.when(hit, value)
    return df.withColumn("weight", weight)


def draws(space: Mapping[str, Sequence[Any]], count: int, seed: int) -> list[dict[str, Any]]:
    """``count`` different settings out of all combinations, the same for the same seed."""
    picker, total = random.Random(seed), 1
    for values in space.values():
        total *= len(values)
    out = []
    for index in picker.sample(range(total), min(count, total)):
        setting = {}
        for name, values in space.items():
            index, at = divmod(index, len(values))
            setting[name] = values[at]
        out.append(setting)
    return out


def search(
    train: DataFrame,
    features: Sequence[str],
    learner,
    keys: Sequence[str],
    space: Mapping[str, Sequence[Any]],
    count: int = 20,
    fold_count: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    stratify: bool = True,
):
    """Random search with fixed folds; returns the refitted best model and one row per setting.

    Classifiers are judged by F1 of class 1, regressors by mean absolute error.
    """
    label = learner.getLabelCol()
    settings = draws(space, count, seed)
    grids = [
        ParamGridBuilder().baseOn(*[(learner.getParam(n), v) for n, v in s.items()]).build()[0] for s in settings
    ]
    classify = learner.hasParam("rawPredictionCol")
    evaluator = (
        MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
        if classify
        else RegressionEvaluator(labelCol=label, metricName="mae")
    )
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    prepared = ft.folds(train, keys, fold_count, seed, label if classify and stratify else None)
    validator = CrossValidator(
        estimator=learner,
        estimatorParamMaps=grids,
        evaluator=evaluator,
        numFolds=fold_count,
        foldCol="fold",
        seed=seed,
        parallelism=parallelism,
    )
    fitted = validator.fit(vectors.transform(prepared))
    spark = train.sparkSession
    rows = [
        (i, str(s), float(m), float(d)) for i, (s, m, d) in enumerate(zip(settings, fitted.avgMetrics, fitted.stdMetrics))
    ]
    table = spark.createDataFrame(rows, "setting int, params string, score double, score_std double")
    return PipelineModel(stages=[vectors, fitted.bestModel]), table


def prepare(
    train: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    fold_count: int = 5,
    seed: int = 42,
    stratify: bool = True,
    bins: int = 32,
) -> DataFrame:
    """Folds and binned feature vectors, computed once and stored; every fit of a search or a fold report reads them.

    Each feature becomes the number of its quantile bin (``bins`` bins, cut points from one pass over all rows, the
    bins the learners would draw themselves with maxBins = ``bins``); the vector of bins is kept beside ``keys``,
    the label and the fold (equal folds within each label when ``stratify``). Missing values must be filled before
    (``Encoding.apply``); a NaN would get a bin of its own.
    """
    parts = ft.folds(train.select(*keys, label, *features), keys, fold_count, seed, label if stratify else None)
    binned_names = [f"bin_{i}" for i in range(len(features))]
    discretizer = QuantileDiscretizer(
        inputCols=list(features), outputCols=binned_names, numBuckets=bins, handleInvalid="keep", relativeError=1 / (4 * bins)
    )
    binned = discretizer.fit(parts).transform(parts)
    vectors = VectorAssembler(inputCols=binned_names, outputCol="features").transform(binned)
    return stored(vectors.select(*keys, label, "fold", "features"))


def search_prepared(
    prepared: DataFrame,
    learner,
    space: Mapping[str, Sequence[Any]],
    count: int = 20,
    seed: int = 42,
    parallelism: int = 4,
):
    """Random search over stored folds and vectors; returns the best model, refitted on all rows, and one row per setting.

    Settings are ``count`` seeded draws of the space; each is fitted once per fold on the other folds. Classifiers are
    judged by F1 of class 1, regressors by mean absolute error (lower is better). ``chosen`` marks the best setting,
    the first drawn among equals. The fits and the scores read weighted cells (``weighted_cells``), not single rows.
    """
    label = learner.getLabelCol()
    settings = draws(space, count, seed)
    grids = [ParamGridBuilder().baseOn(*[(learner.getParam(n), v) for n, v in s.items()]).build()[0] for s in settings]
    classify = learner.hasParam("rawPredictionCol")
    evaluator = (
        MulticlassClassificationEvaluator(labelCol=label, weightCol=WEIGHT, metricName="fMeasureByLabel", metricLabel=1.0)
        if classify
        else RegressionEvaluator(labelCol=label, weightCol=WEIGHT, metricName="mae")
    )
    pieces = max(_pieces(learner.copy(g)) for g in grids)
    cells = weighted_cells(prepared, ["fold", "features"], learner, pieces)
    folds = cells.select("fold").distinct().count()  # one row per fold
    validator = CrossValidator(
        estimator=learner.copy({learner.weightCol: WEIGHT}), estimatorParamMaps=grids, evaluator=evaluator, numFolds=folds, foldCol="fold", seed=seed, parallelism=parallelism
    )
    fitted = validator.fit(cells)
    scores = list(fitted.avgMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i] if classify else -scores[i], -i))
    rows = [(i, params_text(s), float(m), float(d), i == best) for i, (s, m, d) in enumerate(zip(settings, scores, fitted.stdMetrics))]
    table = prepared.sparkSession.createDataFrame(rows, "setting int, params string, score double, score_std double, chosen boolean")
    return fitted.bestModel, table


def params_text(setting: Mapping[str, Any]) -> str:
    """A setting as ``name=value`` pairs in name order, joined by ``;``."""
    return ";".join(f"{k}={setting[k]}" for k in sorted(setting))


def out_of_fold(prepared: DataFrame, learner, keys: Sequence[str]) -> DataFrame:
    """Each row's prediction by the model fitted on the other folds; one table, stored once, written by all fold models.

    The models are fitted on weighted cells (``weighted_cells``); every row is predicted.
    Columns: ``keys``, fold, label (as int), prediction, probability of class 1.
    """
    label = learner.getLabelCol()
    cells = weighted_cells(prepared, ["fold", "features"], learner, _pieces(learner))
    weighed = learner.copy({learner.weightCol: WEIGHT})
    folds = [r["fold"] for r in prepared.select("fold").distinct().orderBy("fold").collect()]  # one row per fold
    parts = []
    for fold in folds:
        model = weighed.fit(cells.where(F.col("fold") != fold))
        held = model.transform(prepared.where(F.col("fold") == fold))
        parts.append(held.select(*keys, "fold", F.col(label).cast("int").alias("label"), "prediction",
                                 vector_to_array("probability")[1].alias("probability")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return stored(whole)


FOLD_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def fold_report(predictions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 (class 1) and exact ROC AUC of each fold, then their mean and deviation.

    Rows are reduced to one per (fold, probability, prediction) with the counts of both labels; a running count of
    negatives below each score (window per fold over those groups only) gives the AUC, and one aggregate by fold
    gives all metrics. Returns ``metric, mean, std`` (population deviation over folds).
    """
    pos, neg = F.count_if(F.col("label") == 1), F.count_if(F.col("label") != 1)
    groups = predictions.groupBy("fold", F.col("probability").alias("s"), (F.col("prediction") == 1).alias("said")).agg(
        pos.alias("pos"), neg.alias("neg")
    )
    scores = groups.groupBy("fold", "s").agg(F.sum("pos").alias("s_pos"), F.sum("neg").alias("s_neg"))
    below = Window.partitionBy("fold").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = scores.withColumn("neg_below", F.coalesce(F.sum("s_neg").over(below), F.lit(0)))
    won = ranked.groupBy("fold").agg(
        F.sum(F.col("s_pos").cast("double") * (F.col("neg_below") + F.col("s_neg") / 2)).alias("won")
    )
    c = F.col
    counts = groups.groupBy("fold").agg(
        F.sum(F.when(c("said"), c("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(c("said"), c("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~c("said"), c("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~c("said"), c("neg")).otherwise(0)).alias("tn"),
    )
    per_fold = counts.join(won, "fold").select(
        "fold",
        mt.ratio(c("tp") + c("tn"), c("tp") + c("tn") + c("fp") + c("fn")).alias("accuracy"),
        mt.ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
        mt.ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
        mt.ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1"),
        (c("won") / F.nullif((c("tp") + c("fn")).cast("double") * (c("fp") + c("tn")), F.lit(0.0))).alias("roc_auc"),
    )
    return mt.across_folds(per_fold, FOLD_METRICS)


def scored(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """``label, prediction, probability`` of a classifier's rows."""
    return model.transform(df).select(
        F.col(label).cast("int").alias("label"),
        "prediction",
        vector_to_array("probability")[1].alias("probability"),
    )


def fold_metrics(train: DataFrame, features: Sequence[str], learner, keys: Sequence[str], fold_count: int = 5, seed: int = 42) -> DataFrame:
    """One row of metrics per fold for one setting of a classifier."""
    label = learner.getLabelCol()
    parts = ft.folds(train, keys, fold_count, seed, label)
    rows = []
    for i in range(fold_count):
        model = assembled(learner, features).fit(parts.where(F.col("fold") != i))
        held = scored(model, parts.where(F.col("fold") == i), label)
        rows.append(quality(held).withColumn("fold", F.lit(i)))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def quality(predictions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC AUC in one row."""
    auc = mt.roc_auc(predictions).withColumn("__one", F.lit(1))
    # One row on each side.
    return mt.class_metrics(predictions).withColumn("__one", F.lit(1)).join(auc, "__one").drop("__one")


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``encoded_feature, importance`` of a fitted tree model."""
    values = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(features, values)], "encoded_feature string, importance double"
    )
