"""Reporting queries over the warehouse tables and the rule-based score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creascope.functions.cleaning import display_name, feature_category

# Fixed values of the rule-based score.
BASE_RATE = 0.12
DEVICE_FACTOR, OS_FACTOR, REGION_FACTOR, VIDEO_FACTOR = 1.15, 1.08, 1.10, 1.12
CPE_SLOPE = 0.3
BRIGHTNESS_RULE, SATURATION_RULE, COLOR_RULE = (0.8, 0.004), (0.85, 0.003), (0.9, 0.002)
CTR_SHARE = 0.45
LOW_BELOW, HIGH_ABOVE, TOP_ABOVE = 0.08, 0.12, 0.15


def latest_run_timestamp(df: DataFrame) -> DataFrame:
    return df.agg(F.max("run_timestamp").alias("run_timestamp"))


def latest_run(df: DataFrame) -> DataFrame:
    """All rows of the latest run; the timestamp becomes a literal that reaches the scan."""
    return df.filter(F.col("run_timestamp") == latest_run_timestamp(df).scalar())


def latest_of_model(benchmarks: DataFrame, model: str) -> DataFrame:
    """The newest row of one model; of equal times the one with the smallest metrics."""
    rows = benchmarks.filter(F.col("model_name") == model)
    ties = [c for c in ("mae", "rmse", "r2", "mape") if c in rows.columns]
    return rows.orderBy(F.desc("run_timestamp"), *ties).limit(1)


def dashboard_stats(
    metrics: DataFrame, creatives: DataFrame, campaigns: DataFrame, benchmarks: DataFrame
) -> DataFrame:
    """Totals for the dashboard in one row; empty inputs give 0."""
    r2 = latest_of_model(benchmarks, "multimodal").agg(F.coalesce(F.max("r2"), F.lit(0.0))).scalar()
    return metrics.agg(
        F.coalesce(F.sum("n_impressions"), F.lit(0)).alias("total_impressions")
    ).select(
        "total_impressions",
        creatives.agg(F.count("*")).scalar().alias("total_creatives"),
        campaigns.agg(F.count("*")).scalar().alias("total_campaigns"),
        F.round(r2, 4).alias("multimodal_r2"),
    )


def latest_benchmarks(benchmarks: DataFrame) -> DataFrame:
    """Rounded metrics of every model in the latest run."""
    return latest_run(benchmarks).select(
        "model_name",
        F.round("r2", 4).alias("r2"), F.round("mae", 4).alias("mae"),
        F.round("mape", 2).alias("mape"), "n_features")


def top_features(importances: DataFrame, n: int = 10, model: str = "multimodal") -> DataFrame:
    """The ``n`` most important features of a model in the latest run."""
    rows = latest_run(importances).filter(F.col("model_name") == model)
    top = rows.orderBy(F.desc("importance_score"), "feature_name").limit(n)
    return top.select(
        "feature_name",
        display_name(F.col("feature_name")).alias("name"),
        F.round("importance_score", 4).alias("importance"),
        feature_category(F.col("feature_name")).alias("category"))


def model_summary(benchmarks: DataFrame) -> DataFrame:
    """Metrics side by side for the run report; models without metrics are left out."""
    return benchmarks.filter(F.col("mae").isNotNull()).select(
        "model_name", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
        F.round("r2", 4).alias("r2"), F.round("mape", 2).alias("mape"), "n_features"
    ).orderBy("model_name")


def benchmark_long(benchmarks: DataFrame) -> DataFrame:
    """(model, metric, value) for charts, MAPE as a fraction."""
    shown = benchmarks.select(
        F.initcap("model_name").alias("model"), F.col("mae").alias("MAE"),
        F.col("rmse").alias("RMSE"), (F.col("mape") / 100).alias("MAPE"), F.col("r2").alias("R2"))
    return shown.unpivot(["model"], ["MAE", "RMSE", "MAPE", "R2"], "metric", "value")


def tier(er: Column) -> Column:
    return (
        F.when(er < LOW_BELOW, "low").when(er > TOP_ABOVE, "top")
        .when(er > HIGH_ABOVE, "high").otherwise("avg")
    )


def heuristic_score(df: DataFrame) -> DataFrame:
    """Rule-based rates and tier for every row of a table.

    Reads device, os, region, cpe, brightness, saturation, colorfulness (visual values on a
    0-100 scale) and has_video.
    """
    def boost(condition: Column, factor: float) -> Column:
        return F.when(condition, factor).otherwise(1.0)

    def line(column: str, rule: tuple[float, float]) -> Column:
        return rule[0] + F.col(column) * rule[1]

    er = (
        F.lit(BASE_RATE)
        * boost(F.col("device") == "smartphone", DEVICE_FACTOR)
        * boost(F.col("os") == "iOS", OS_FACTOR)
        * boost(F.col("region") == "USA", REGION_FACTOR)
        * (1 - F.col("cpe") * CPE_SLOPE)
        * line("brightness", BRIGHTNESS_RULE)
        * line("saturation", SATURATION_RULE)
        * line("colorfulness", COLOR_RULE)
        * boost(F.col("has_video"), VIDEO_FACTOR)
    )
    scored = df.withColumn("_er", er)
    return scored.withColumns({
        "er_percent": F.round(F.col("_er") * 100, 1),
        "ctr_percent": F.round(F.col("_er") * CTR_SHARE * 100, 1),
        "tier": tier(F.col("_er")),
        "tier_label": tier_label(tier(F.col("_er"))),
    }).drop("_er")


# Display text of each tier.
TIER_LABELS = {"low": "🔴 Low", "top": "⭐ Top Performer", "high": "🟢 High", "avg": "🟡 Average"}


def tier_label(name: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in TIER_LABELS.items() for x in pair])
    return F.element_at(labels, name)
