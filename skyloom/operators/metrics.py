"""Quality of predictions, each table in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.operators.slices import ROWS_PER_SLICE, running_totals
from skyloom.session import stored


def ratio(part: Column, whole: Column) -> Column:
    """0 when undefined."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias(label), F.col(prediction).cast("int").alias(prediction)
    ).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y == p).alias("hits"),
        F.count(F.lit(1)).alias("n"),
    )
    c = F.col
    return counts.select(
        ratio(c("hits"), c("n")).alias("accuracy"),
        ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
        ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
        ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1"),
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of each class, from the confusion counts."""
    cells = confusion(df, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col(label).alias("class"), F.lit(1).alias("is_label"), F.col("n").alias("n"), (F.col(label) == F.col(prediction)).alias("hit")),
                F.struct(F.col(prediction).alias("class"), F.lit(0).alias("is_label"), F.col("n").alias("n"), (F.col(label) == F.col(prediction)).alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per_class = sides.groupBy("class").agg(
        F.sum(F.when(F.col("is_label") == 1, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("is_label") == 0, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when((F.col("is_label") == 1) & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
    )
    c = F.col
    return per_class.select(
        "class",
        ratio(c("tp"), c("predicted")).alias("precision"),
        ratio(c("tp"), c("support")).alias("recall"),
        ratio(2 * c("tp"), c("predicted") + c("support")).alias("f1"),
        "support",
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "probability", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Exact area under the ROC curve; equal scores share their rank. Null with one class only."""
    # Read by the slice limits, the totals and the ranks; the scores behind it are computed once.
    groups = stored(
        df.groupBy(F.col(score).alias("s")).agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
        )
    )
    ranked = running_totals(groups, ["s"], {"neg": "neg_below"}, rows_per_slice)
    # In double precision: products of counts pass the range of long integers.
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = F.sum(pos * (F.col("neg_below").cast("double") + neg / 2))
    return ranked.agg((won / F.nullif(F.sum(pos) * F.sum(neg), F.lit(0.0))).alias("roc_auc"))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean absolute error, root mean squared error and R2."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"),
    )


def gaps(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per metric: train value, test value, and their difference."""
    names = train.columns
    long = train.unpivot([], names, "metric", "train")
    other = test.select(*names).unpivot([], names, "metric", "test")
    return long.join(other, "metric").withColumn("gap", F.col("train") - F.col("test"))


def across_folds(per_fold: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and (population) deviation of each metric over the folds."""
    long = per_fold.unpivot([], metrics, "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
