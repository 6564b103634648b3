"""Writing and reading tables by folder: overwrite, append, skip, cache and count."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from creascope.functions.cleaning import feature_category


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a table, schema taken from the frame; the row count comes from the same job."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return written.get["rows"]


def write_if_empty(df: DataFrame, path: str) -> int | None:
    """Load only into a missing or empty table; None when the load was skipped."""
    spark = df.sparkSession
    if exists(spark, path) and not read_table(spark, path).isEmpty():
        return None
    return write_table(df, path)


def materialize(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], force: bool = False
) -> DataFrame:
    """Stored table if present, otherwise compute, store and read it back."""
    if force or not exists(spark, path):
        write_table(compute(), path)
    return read_table(spark, path)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows) for several tables in one query."""
    counts = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def run_metrics(models: DataFrame, run_timestamp) -> DataFrame:
    """Rows of ``model_benchmarks`` for one run: failed models left out, missing metrics 0."""
    zero = F.lit(0.0)
    ok = models.filter(F.col("error").isNull()) if "error" in models.columns else models
    name = "model" if "model" in ok.columns else "model_name"

    def metric(kind: str):
        present = f"{kind}_mean" if f"{kind}_mean" in ok.columns else kind
        return F.coalesce(F.col(present), zero).alias(kind)

    return ok.select(
        run_timestamp.alias("run_timestamp"), "target_metric", F.col(name).alias("model_name"),
        *[metric(kind) for kind in ("mae", "rmse", "r2", "mape")],
        F.coalesce(F.col("n_features"), F.lit(0)).cast("long").alias("n_features"))


def run_importances(importances: DataFrame, run_timestamp) -> DataFrame:
    """Rows of ``feature_importances`` for one run."""
    renamed = importances.withColumnsRenamed(
        {"model": "model_name", "feature": "feature_name", "importance": "importance_score"})
    return renamed.select(
        run_timestamp.alias("run_timestamp"), "model_name", "feature_name", "importance_score",
        feature_category(F.col("feature_name")).alias("category"))


def append_run(models: DataFrame, importances: DataFrame, root: str, run_timestamp=None) -> None:
    """Append one run to ``model_benchmarks`` and ``feature_importances``; history is kept.

    Both tables carry the attempt that wrote them. The row appended to ``runs`` at the end commits the
    attempt: until then ``read_run`` shows neither part, and a repeated run replaces the earlier one.
    """
    spark = models.sparkSession
    stamp = F.current_timestamp() if run_timestamp is None else run_timestamp
    # one instant and one attempt for all tables
    commit = spark.range(1).select(stamp.alias("run_timestamp"), F.expr("uuid()").alias("attempt")).first()
    stamp, attempt = F.lit(commit["run_timestamp"]), F.lit(commit["attempt"]).alias("attempt")
    write_table(run_metrics(models, stamp).select("*", attempt), f"{root}/model_benchmarks", mode="append")
    write_table(run_importances(importances, stamp).select("*", attempt), f"{root}/feature_importances", mode="append")
    write_table(
        spark.range(1).select(stamp.alias("run_timestamp"), attempt, F.current_timestamp().alias("committed_at")),
        f"{root}/runs", mode="append")


def read_run(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of ``model_benchmarks`` or ``feature_importances`` of committed runs, the last attempt of each."""
    rows = read_table(spark, f"{root}/{table}")
    if not exists(spark, f"{root}/runs"):
        return rows.drop("attempt").filter(F.lit(False))
    last = read_table(spark, f"{root}/runs").groupBy("run_timestamp").agg(
        F.max_by("attempt", F.struct("committed_at", "attempt")).alias("attempt"))
    return rows.join(last, ["run_timestamp", "attempt"], "left_semi").drop("attempt")
