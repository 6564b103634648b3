"""Regression metrics and their summary over folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

METRICS = ["mae", "rmse", "r2", "mape"]


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """MAE, RMSE, R2 and MAPE of columns ``y`` and ``prediction`` per group.

    Predictions below 0 count as 0. MAPE uses rows with a non-zero target and is NaN without
    any. R2 of a constant target is 1 for a perfect fit and 0 otherwise.
    """
    y = F.col("y").cast("double")
    error = y - F.greatest(F.col("prediction").cast("double"), F.lit(0.0))
    sums = predictions.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(error * error).alias("sse"),
        (F.var_pop(y) * F.count("*")).alias("sst"),
        F.avg(F.when(y != 0, F.abs(error / y))).alias("ape"),
    )
    nan = F.lit(float("nan"))
    constant = F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("sst") == 0, constant).otherwise(1 - F.try_divide("sse", "sst"))
    return sums.select(
        *by, "n", "mae",
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        F.when(F.col("n") < 2, nan).otherwise(r2).alias("r2"),
        F.coalesce(F.col("ape") * 100, nan).alias("mape"),
    )


def fold_summary(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation of every metric over the folds."""
    return metrics.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in METRICS],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in METRICS],
        F.count("*").alias("n_folds"),
    )


def mean_importance(importances: DataFrame, k: int, by: Sequence[str] = ("model",)) -> DataFrame:
    """Importance summed over folds and divided by the configured number of folds."""
    summed = importances.groupBy(*by, "feature").agg((F.sum("importance") / k).alias("importance"))
    return summed.orderBy(*by, F.desc("importance"), "feature")


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target, highest first, in one aggregation."""
    wide = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f) for f in features])
    long = wide.unpivot([], list(features), "feature", "correlation")
    return long.orderBy(F.desc_nulls_last("correlation"), "feature")
