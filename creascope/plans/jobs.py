"""End-to-end jobs: warehouse load, feature table, model comparison, training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from creascope.functions.columns import keep_present
from creascope.operators import kpi, linking
from creascope.operators.design import flatten_design, legacy_design_table
from creascope.operators.features import feature_matrix
from creascope.operators.models import (
    TARGETS, FitFn, Model, benchmark, fit_boosted, fit_targets, load_model, model_kind, save_model, score)
from creascope.operators.vision import vision_table
from creascope.schemas import INVENTORY
from creascope.sinks.tables import (
    append_run, exists, materialize, read_table, write_if_empty, write_json, write_table,
)
from creascope.session import stash
from creascope.sources.files import read_images, scan_assets


def load_staging(
    spark: SparkSession,
    out: str,
    inventory: DataFrame | None = None,
    briefing: DataFrame | None = None,
    design_docs: DataFrame | None = None,
    assets: DataFrame | None = None,
    vision: DataFrame | None = None,
) -> dict[str, int | None]:
    """Store the raw tables that are given; rows written per table, None where skipped.

    The event log is only loaded into an empty table, the others are replaced.
    """
    written: dict[str, int | None] = {}
    if inventory is not None:
        events = keep_present(inventory, INVENTORY.fieldNames())
        written["raw_inventory"] = write_if_empty(events, f"{out}/raw_inventory")
    design = None if design_docs is None else flatten_design(design_docs)
    for name, df in {
        "raw_briefing": briefing, "raw_design_metadata": design,
        "raw_creative_assets": assets, "raw_vision_features": vision,
    }.items():
        if df is not None:
            written[name] = write_table(df, f"{out}/{name}")
    return written


def build_vision(
    spark: SparkSession, out: str, folder: str, make_predict_fn=None,
    k: int = 32, image_size: int = 224, reuse_projection: bool = False, force: bool = False,
) -> DataFrame:
    """Store the image registry and the image features of a folder, from the cache unless forced.

    The fitted projection is stored too; ``reuse_projection`` applies the stored one, which
    keeps the components of new images comparable with those a model was trained on.
    """
    def compute() -> DataFrame:
        saved = f"{out}/models/projection"
        given = PipelineModel.load(saved) if reuse_projection else None
        registry = scan_assets(spark, folder)
        write_table(registry, f"{out}/raw_creative_assets")
        table, projection = vision_table(
            registry, read_images(spark, folder), make_predict_fn, k, image_size, projection=given)
        if projection is not None and given is None:
            projection.write().overwrite().save(saved)
        return table

    return materialize(spark, f"{out}/raw_vision_features", compute, force)


def write_legacy_design(design_docs: DataFrame, path: str) -> int:
    """Store the older nine-column design table."""
    return write_table(legacy_design_table(design_docs), path)


def build_warehouse(
    spark: SparkSession, out: str, tie: Sequence[str] = (), on_orphans: str = "quarantine",
) -> dict[str, int]:
    """Build campaigns, creatives and creative_metrics from the staging tables, in that order.

    Metrics of a campaign without briefing are written to ``creative_metrics_orphans`` or,
    with ``on_orphans="fail"``, stop the load.
    """
    def staged(name: str) -> DataFrame:
        return read_table(spark, f"{out}/{name}")

    # the only scan of the event log
    counts = stash(kpi.context_counts(staged("raw_inventory")), "context_counts")
    design, vision = (
        staged(name) if exists(spark, f"{out}/{name}") else None
        for name in ("raw_design_metadata", "raw_vision_features"))
    written = {
        "campaigns": write_table(linking.campaigns(staged("raw_briefing"), tie), f"{out}/campaigns"),
        "creatives": write_table(
            linking.creatives(counts, vision, design), f"{out}/creatives"),
    }
    campaigns, creatives = staged("campaigns"), staged("creatives")
    metrics = stash(kpi.metrics_from_counts(counts, creatives), "creative_metrics")
    lost = linking.orphans(metrics, campaigns, "campaign_id")
    if on_orphans == "fail" and not lost.isEmpty():
        raise ValueError("creative metrics refer to campaigns without a briefing")
    written["creative_metrics_orphans"] = write_table(lost, f"{out}/creative_metrics_orphans")
    kept = metrics.join(campaigns.select("campaign_id"), "campaign_id", "left_semi")
    written["creative_metrics"] = write_table(kept, f"{out}/creative_metrics")
    return written


def linked_table(spark: SparkSession, out: str) -> DataFrame:
    """Linked dataset from the stored warehouse, ordered by campaign and creative."""
    tables = [read_table(spark, f"{out}/{name}") for name in (
        "creative_metrics", "creatives", "campaigns", "raw_design_metadata")]
    return linking.linked_from_tables(*tables).orderBy("campaign_id", "game_key")


def build_features(spark: SparkSession, out: str, force: bool = False) -> DataFrame:
    """Feature table and its dictionaries, from the cache unless ``force`` is set."""
    def compute() -> DataFrame:
        path = f"{out}/raw_vision_features"
        vision = read_table(spark, path) if exists(spark, path) else None
        features, encoders, _ = feature_matrix(linked_table(spark, out), vision)
        write_table(encoders, f"{out}/encoders")
        return features

    return materialize(spark, f"{out}/feature_dataset", compute, force)


def run_benchmark(
    spark: SparkSession, out: str, target: str = TARGETS[0], fit: FitFn = fit_boosted, **options,
) -> tuple[DataFrame, DataFrame]:
    """Four-way comparison on the feature table; appended to the run history and kept as JSON."""
    models, importances = benchmark(build_features(spark, out), target=target, fit=fit, **options)
    models, importances = stash(models, "models"), stash(importances, "importances")
    append_run(models, importances, out)
    write_json(models, f"{out}/benchmark_results.json")
    return models, importances


def train_final(
    feature_df: DataFrame, encoders: DataFrame, out: str,
    targets: Sequence[str] = TARGETS, fit: FitFn = fit_boosted,
) -> Mapping[str, Model]:
    """Fit the combined model per target on all its rows and store models and dictionaries."""
    models = fit_targets(feature_df, targets, fit)
    for target, model in models.items():
        save_model(feature_df.sparkSession, model, f"{out}/models/{target}")
    write_table(encoders, f"{out}/models/encoders")
    listing = feature_df.sparkSession.createDataFrame(
        [(target, model_kind(model)) for target, model in models.items()], "target string, kind string")
    write_table(listing, f"{out}/models/targets")
    return models


def score_batch(df: DataFrame, out: str, keep: Sequence[str] = ("game_key",)) -> DataFrame:
    """Predicted rates for a table of creatives with the stored models."""
    spark = df.sparkSession
    listing = read_table(spark, f"{out}/models/targets").collect()
    models = {row["target"]: load_model(spark, f"{out}/models/{row['target']}", row["kind"]) for row in listing}
    return score(df, models, read_table(spark, f"{out}/models/encoders"), keep)
