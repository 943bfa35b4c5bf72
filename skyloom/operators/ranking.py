"""Which features go with the target: correlation, importance, and both combined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions.values import min_max, weighted


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target, undefined ones 0; one pass."""
    y = F.col(f"`{target}`").cast("double")

    def correlation(name: str) -> Column:
        # By parts, since ``corr`` raises on a constant column in ANSI mode.
        x = F.col(f"`{name}`").cast("double")
        both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        spread = F.stddev_pop(both_x) * F.stddev_pop(both_y)
        return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))

    row = df.agg(*[correlation(c).alias(c) for c in features])
    long = row.unpivot([], list(features), "raw_feature", "corr_with_target")
    value = F.coalesce(F.nanvl(F.col("corr_with_target"), F.lit(0.0)), F.lit(0.0))
    return long.withColumn("corr_with_target", value).withColumn("abs_corr", F.abs("corr_with_target"))


def by_strength(table: DataFrame, column: str, name: str) -> DataFrame:
    """Sorted by absolute value, strongest first."""
    return table.orderBy(F.abs(column).desc(), name)


def base_feature(encoded: Column, columns: Sequence[str]) -> Column:
    """Encoded feature name -> table column: ``num__x`` is x, ``cat__x_value`` the longest fit."""
    name = F.regexp_replace(encoded, "^(num|cat)__", "")
    # ``when`` takes the first hit, so the longest column names are tried first.
    fit = None
    for c in sorted(columns, key=lambda c: (-len(c), c)):
        hit = (name == c) | F.startswith(name, F.lit(c + "_"))
        fit = F.when(hit, c) if fit is None else fit.when(hit, c)
    category = F.startswith(encoded, F.lit("cat__"))
    return F.when(category, F.coalesce(fit, F.split_part(name, F.lit("_"), F.lit(1)))).otherwise(
        F.regexp_replace(encoded, "^num__", "")
    )


def summed_importance(importances: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Importance of encoded features summed per table column."""
    return (
        importances.withColumn("raw_feature", base_feature(F.col("encoded_feature"), columns))
        .groupBy("raw_feature")
        .agg(F.sum("importance").alias("importance"))
    )


def combined(correlation: DataFrame, importance: DataFrame) -> DataFrame:
    """Outer join of both scores, missing 0, min-max scaled; score = 0.7 importance + 0.3 correlation."""
    joined = correlation.join(importance, "raw_feature", "outer").fillna(0.0)
    limits = joined.agg(
        F.min("abs_corr").alias("__cl"), F.max("abs_corr").alias("__ch"),
        F.min("importance").alias("__il"), F.max("importance").alias("__ih"),
    )
    # One aggregate row beside a table with one row per feature.
    scaled = _beside(joined, limits).withColumns(
        {
            "corr_norm": min_max(F.col("abs_corr"), F.col("__cl"), F.col("__ch")),
            "importance_norm": min_max(F.col("importance"), F.col("__il"), F.col("__ih")),
        }
    )
    return scaled.withColumn("final_score", weighted(F.col("importance_norm"), F.col("corr_norm"))).drop(
        "__cl", "__ch", "__il", "__ih"
    )


def combined_by_max(correlation: DataFrame, importance: DataFrame) -> DataFrame:
    """Inner join of both scores, each divided by its maximum, same weights."""
    joined = correlation.join(importance, "raw_feature", "inner")
    limits = joined.agg(F.max("abs_corr").alias("__ch"), F.max("importance").alias("__ih"))
    scaled = _beside(joined, limits).withColumns(
        {
            "corr_norm": F.col("abs_corr") / F.nullif(F.col("__ch"), F.lit(0.0)),
            "importance_norm": F.col("importance") / F.nullif(F.col("__ih"), F.lit(0.0)),
        }
    )
    return scaled.withColumn("final_score", weighted(F.col("importance_norm"), F.col("corr_norm"))).drop("__ch", "__ih")


def _beside(table: DataFrame, one_row: DataFrame) -> DataFrame:
    return table.withColumn("__one", F.lit(1)).join(
        F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one"
    ).drop("__one")


def top(table: DataFrame, count: int, score: str = "final_score", name: str = "raw_feature") -> DataFrame:
    return table.orderBy(F.desc(score), name).limit(count)
