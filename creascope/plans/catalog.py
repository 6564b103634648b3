"""One named query per operator, over the domain tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from creascope.functions import cleaning
from creascope.functions.columns import feature_sets, keep_present
from creascope.operators import (
    boosting, design, features, folds, kpi, linking, metrics, models, reports, vision,
)
from creascope.plans.binding import Domain
from creascope.session import stash
from creascope.sinks.tables import run_importances, run_metrics, table_counts
from creascope.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a fixed number of digits, without negative zero; dates without time."""
    shown = {"double": f"round(`{{0}}`, {digits}) + 0D as `{{0}}`", "timestamp": "cast(`{0}` as date) as `{0}`"}
    return df.selectExpr([shown.get(dtype, "`{0}`").format(name) for name, dtype in df.dtypes])


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    """Register a query under the name of its function."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(Domain(spark, folder)))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# --- sources -----------------------------------------------------------------------------

@query
def briefing_latest(d):
    """Latest briefing per campaign, parsed dates and numbers."""
    return d.briefing


@query
def inventory_clean(d):
    """Whole event log with cleaned types."""
    return d.inventory.select("event_id", "type", "game_key", "campaign_id", "browser_ts")


@query
def vision_rows(d):
    """All image feature rows."""
    return d.vision


@query
def asset_registry(d):
    """Image registry: name parts, placement and size, ordered by file name."""
    return d.assets.orderBy("filename")


@query
def column_scan(d):
    """Two columns of a Parquet table; only they are read."""
    return d.table("part").select("p_partkey", "p_brand")


@query
def event_preview(d):
    """The first 1000 raw events in the order of the stored log."""
    placed = files.with_position(d.table("events").select("event_id", "_metadata"))
    first = files.preview(placed.select("event_id", "position"), 1000, "position")
    shown = ["event_id", "game_key", "type", "device_type", "platform_os", "geo_country"]
    return d.raw_inventory.select(*shown).join(first, "event_id", "left_semi")


@query
def event_union(d):
    """Two parts of the log with different columns, read as one table."""
    events = d.table("events")
    views = events.filter("event_type = 'view'").select("event_id", "event_type")
    others = events.filter("event_type <> 'view'").select("event_id", "event_type", "value")
    return files.concat(views, others)


# --- scalar rules ------------------------------------------------------------------------

@query
def game_key_parts(d):
    """Slug, request id and image file of every event's game key."""
    slug, request_id = cleaning.split_game_key(F.col("game_key"))
    return d.inventory.select(
        "event_id", slug.alias("creative_slug"), request_id.alias("creative_request_id"),
        cleaning.image_filename(slug, request_id).alias("image_filename"))


@query
def briefing_projection(d):
    """Only the known briefing columns, renamed."""
    wanted = {"campaign_id": "campaign", "kpis": "kpis", "currency": "currency", "absent": "absent"}
    return keep_present(d.raw_briefing, wanted)


@query
def campaign_durations(d):
    """Days per submission, floored at 0, NULL when a date is unreadable."""
    parsed = d.raw_briefing.select("submission_id", *[
        cleaning.parse_time(F.col(c), cleaning.DAY_FIRST_FORMATS).alias(c) for c in ("startdate", "enddate")])
    return parsed.withColumn("days", cleaning.duration_days(F.col("startdate"), F.col("enddate")))


@query
def feature_categories(d):
    """Visual or contextual, per feature name of the run history."""
    return d.importances.select("feature_name", "category").distinct()


# --- nested documents --------------------------------------------------------------------

@query
def design_flat(d):
    """Two keys and 20 features per design request."""
    return d.design


@query
def design_legacy(d):
    """Older design layout; colour maps shown by their keys."""
    table = design.legacy_design_table(d.design_docs)
    return table.withColumns({
        c: F.array_join(F.array_sort(F.map_keys(F.coalesce(c, F.create_map().cast("map<string,string>")))), ",")
        for c in ("color_engagement", "color_click_through")})


@query
def design_keys(d):
    """Composite key of every design request."""
    return design.request_keys(d.design_docs)


# --- joins -------------------------------------------------------------------------------

@query
def images_to_design(d):
    """Registered images with their design record."""
    joined = linking.resolve_images(d.assets, d.design)
    return joined.select("filename", "request_id", "md5_game_key", "color_diversity", "interaction_direction")


@query
def image_match_rate(d):
    """Share of images with a design record."""
    return linking.match_rate(linking.resolve_images(d.assets, d.design), "md5_game_key")


@query
def linked_dataset(d):
    """KPIs with design and campaign context."""
    return d.linked


@query
def vision_join(d):
    """Linked rows with image columns; columns of the design side win."""
    joined = linking.attach_vision(d.linked, d.vision, order=("vec_id",))
    return joined.select(
        "campaign_id", "game_key", "device_type", "platform_os", "geo_country", "md5_game_key",
        "image_filename", "aspect_ratio", "brightness_mean", "file_size_kb", "vision_pca_0", "vision_pca_31")


@query
def linked_from_warehouse(d):
    """The linked table read from metrics, creatives, campaigns and design."""
    return linking.linked_from_tables(
        d.metrics, linking.creative_keys(d.counts), d.campaigns, d.design).orderBy(
        "campaign_id", "game_key")


@query
def creative_dimension(d):
    """Creatives with image measures and defaults."""
    return d.creatives


@query
def campaign_dimension(d):
    """Campaigns from the latest briefing."""
    return d.campaigns


@query
def metric_orphans(d):
    """Metrics of campaigns that have no briefing."""
    return linking.orphans(d.metrics, d.campaigns, "campaign_id")


@query
def key_overlap(d):
    """Request ids of the event log against those of the design documents."""
    events = d.inventory.select(cleaning.split_game_key(F.col("game_key"))[1].alias("request_id"))
    return linking.key_overlap(events, d.design, "request_id")


@query
def distinct_keys(d):
    """Distinct game keys of the log."""
    return d.inventory.select("game_key").distinct()


@query
def vision_first(d):
    """First image row per file."""
    return linking.first_per_key(d.vision, ["filename"], [F.asc("vec_id")]).select(
        "filename", "vec_id", "brightness_mean", "file_size_kb")


# --- aggregations ------------------------------------------------------------------------

@query
def creative_kpis(d):
    """KPI table: minimum impressions, clipped rates, NULL keys dropped."""
    return d.kpis


@query
def creative_kpis_null_keys(d):
    """KPI table that keeps NULL keys and unclipped rates, no minimum."""
    return kpi.creative_kpis(d.inventory, min_impressions=0, drop_null_keys=False, clipped=False)


@query
def creative_kpis_pivot(d):
    """KPI table with the counts of every event type, found in one scan as a map per key."""
    counted = kpi.creative_kpis(d.inventory, min_impressions=1, keep_types="map")
    others = ("click", "error", "purchase", "signup")
    return counted.withColumns(
        {kind: F.coalesce(F.col("type_counts")[kind], F.lit(0)) for kind in others}).drop("type_counts")


@query
def creative_metrics(d):
    """Warehouse metrics per campaign, creative and context, for known creatives."""
    return kpi.creative_metrics(d.inventory, linking.creative_keys(d.inventory))


@query
def campaign_kpis(d):
    """Percent rates per campaign."""
    return kpi.campaign_kpis(d.inventory)


@query
def kpi_profile(d):
    """Sizes, distinct keys and spread of the KPI table."""
    return kpi.kpi_profile(d.kpis)


@query
def top_game_keys(d):
    """The five most frequent game keys."""
    return kpi.value_counts(d.inventory, "game_key", 5)


@query
def table_rows(d):
    """Row counts of the warehouse tables."""
    return table_counts({
        "campaigns": d.campaigns, "creatives": d.creatives, "creative_metrics": d.metrics,
        "model_benchmarks": d.benchmarks, "feature_importances": d.importances})


# --- reporting ---------------------------------------------------------------------------

@query
def run_history(d):
    """Metrics of every run and model."""
    return d.benchmarks


@query
def importance_history(d):
    """Feature importances of every run and model."""
    return d.importances


@query
def latest_run_time(d):
    """Time of the latest run."""
    return reports.latest_run_timestamp(d.benchmarks)


@query
def latest_multimodal(d):
    """Newest row of the combined model."""
    return reports.latest_of_model(d.benchmarks, "multimodal")


@query
def latest_benchmarks(d):
    """Metrics of the latest run."""
    return reports.latest_benchmarks(d.benchmarks)


@query
def top_features_10(d):
    """Ten most important features of the latest combined model."""
    return reports.top_features(d.importances, 10)


@query
def top_features_15(d):
    """Fifteen most important features of the latest combined model."""
    return reports.top_features(d.importances, 15)


@query
def dashboard_stats(d):
    """Dashboard totals; the dimensions are counted by their keys, without their context."""
    known = d.raw_briefing.select("campaign_id").filter("campaign_id is not null").distinct()
    return reports.dashboard_stats(d.metrics, linking.creative_keys(d.counts), known, d.benchmarks)


@query
def model_summary(d):
    """Report lines of the latest run."""
    return reports.model_summary(reports.latest_run(d.benchmarks))


@query
def benchmark_long(d):
    """Latest metrics as (model, metric, value)."""
    return reports.benchmark_long(reports.latest_run(d.benchmarks))


@query
def heuristic_scores(d):
    """Rule-based rates and tier for every event context."""
    scored = reports.heuristic_score(d.score_requests)
    return scored.select("event_id", "er_percent", "ctr_percent", "tier", "tier_label")


@query
def target_correlations(d):
    """Correlation of numeric KPI columns with the engagement rate."""
    columns = ["n_impressions", "n_engagements", "n_clicks", "click_through_rate"]
    return metrics.target_correlations(d.kpis, columns, "engagement_rate")


# --- metrics and folds -------------------------------------------------------------------

@query
def regression_metrics(d):
    """MAE, RMSE, R2 and MAPE per model and fold."""
    return metrics.regression_metrics(d.predictions)


@query
def fold_summary(d):
    """Mean and deviation of the metrics over folds."""
    return metrics.fold_summary(metrics.regression_metrics(d.predictions))


@query
def mean_importance(d):
    """Importances averaged over the configured folds."""
    per_fold = d.predictions.groupBy("model", "fold", "feature").agg(F.sum("importance").alias("importance"))
    return metrics.mean_importance(per_fold, 5)


@query
def group_folds(d):
    """Balanced fold of every document source."""
    return folds.assign_group_folds(d.labelled, "source").select("doc_id", "source", "fold")


@query
def group_fold_sizes(d):
    """Rows, groups and shared groups per fold of users, which have unequal sizes."""
    events = d.table("events").select("event_id", "user_id")
    placed = folds.assign_group_folds(events, "user_id")
    per_group = placed.groupBy("user_id").agg(
        F.min("fold").alias("fold"), F.max("fold").alias("other"), F.count("*").alias("n"))
    return per_group.groupBy("fold").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"),
        F.count_if(F.col("fold") != F.col("other")).alias("n_shared"))


@query
def baseline_predictions(d):
    """Out-of-fold mean of the document quality."""
    return models.oof_mean(folds.assign_group_folds(d.labelled, "source"), "quality")


@query
def baseline_benchmark(d):
    """Cross-validated metrics of the mean baseline."""
    predicted = models.oof_mean(folds.assign_group_folds(d.labelled, "source"), "quality")
    return metrics.fold_summary(metrics.regression_metrics(predicted))


# --- features ----------------------------------------------------------------------------

@query
def label_encoding(d):
    """Category dictionaries of the linked table."""
    return features.fit_encoders(d.linked)


@query
def document_encoding(d):
    """Language and source codes of every document."""
    documents = d.table("documents").select("doc_id", "lang", "source")
    dictionary = stash(features.fit_encoders(documents, ["lang", "source"]), "encoders")
    return features.apply_encoders(documents, dictionary, ["lang", "source"], unseen=None)


@query
def unseen_encoding(d):
    """Codes learnt from labelled English documents, applied to all documents."""
    documents = d.table("documents").select("doc_id", "lang", "source")
    known = d.labelled.filter("lang = 'en' and toxic = 0")
    dictionary = stash(features.fit_encoders(known, ["lang", "source"]), "encoders")
    return features.apply_encoders(documents, dictionary, ["lang", "source"])


@query
def feature_medians(d):
    """Exact medians of event value and counter, image measures and prices."""
    events = features.column_medians(d.raw_inventory, ["value", "k"])
    images = features.column_medians(d.vision, ["brightness_mean", "colorfulness", "vision_pca_3"])
    lines = features.column_medians(d.table("lineitem"), ["l_extendedprice", "l_discount"])
    return events.unionByName(images).unionByName(lines)


@query
def feature_matrix(d):
    """Linked rows with codes, image columns and median fill."""
    matrix, _, _ = features.feature_matrix(d.linked, d.vision, vision_order=("vec_id",))
    kept = [*kpi.KEYS, "md5_game_key", "engagement_rate", "click_through_rate"]
    return matrix.select(*kept, *feature_sets(matrix)["multimodal"])


# --- vision ------------------------------------------------------------------------------

@query
def pixel_measures(d):
    """Colour measures per image from its pixel table."""
    return vision.pixel_features(d.pixels, "vec_id")


@query
def image_measures(d):
    """Measures per decoded image, defaults for unreadable ones."""
    measured = vision.colour_measures(d.images)
    return measured.select(F.col("origin").cast("long").alias("vec_id"), *[
        m for m in vision.MEASURES if m != "color_diversity_score"])


@query
def image_color_diversity(d):
    """Colour buckets of the 64x64 thumbnail of every image."""
    return vision.thumbnail_diversity(d.images)


@query
def standardized_embeddings(d):
    """Every embedding with centred and scaled dimensions."""
    scaled = vision.standardize(d.table("embeddings"), "embedding")
    return scaled.select("vec_id", F.posexplode("scaled").alias("dim", "value"))


@query
def embedding_components(d):
    """Principal components of the standardised embeddings."""
    vectors = d.table("embeddings").select("vec_id", "embedding")
    projected = vision.project(vectors, "embedding", vision.fit_projection(vectors, "embedding", 32))
    return vision.widen(projected.select("vec_id", "components"), "components", 32)


@query
def component_norms(d):
    """Squared length of every embedding in all its components: a full rotation keeps it."""
    vectors = d.table("embeddings").select("vec_id", "embedding")
    projected = vision.project(vectors, "embedding", vision.fit_projection(vectors, "embedding", 64))
    squares = F.aggregate("components", F.lit(0.0), lambda acc, x: acc + x * x)
    return projected.select("vec_id", squares.alias("norm"))


def _channel_model():
    """A stand-in for an image network: mean and spread per channel."""
    def load():
        return lambda batch: np.concatenate([batch.mean(axis=(2, 3)), batch.std(axis=(2, 3))], axis=1)

    return load


@query
def image_embeddings(d):
    """Batch inference over all images with a caller's model."""
    embedded = vision.embed_images(d.images, _channel_model(), image_size=32)
    return embedded.select("origin", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "value"))


@query
def image_table(d):
    """Measures and components of every image, one row per file."""
    registry = d.images.select(
        F.col("image.origin").alias("filename"),
        F.lit("adunit").alias("slug"), F.lit(None).cast("string").alias("request_id"),
        F.lit("unknown").alias("placement_type"), F.lit(0.0).alias("file_size_kb"))
    table, _ = vision.vision_table(registry, d.images, _channel_model(), k=4, image_size=32)
    return table


# --- models ------------------------------------------------------------------------------

# The comparison is fitted once per application and data folder and kept as two tables.
_RUNS: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _matrix(d):
    return features.feature_matrix(d.linked, d.vision, vision_order=("vec_id",))


def _comparison(d) -> tuple[DataFrame, DataFrame]:
    """Four-way comparison with boosted trees of the default size."""
    key = (d.spark.sparkContext.applicationId, d.folder)
    if key not in _RUNS:
        table, scores = models.benchmark(_matrix(d)[0])
        _RUNS[key] = stash(table, "comparison"), stash(scores, "importances")
    return _RUNS[key]


@query
def ridge_predictions(d):
    """Ridge fit of document quality on length, predicted for every document."""
    model = models.fit_ridge(d.labelled, ["n_chars"], "quality")
    return model.transform(d.table("documents")).select("doc_id", "prediction")


@query
def ridge_cross_validation(d):
    """Grouped cross-validation of the ridge model on two features."""
    predicted, _ = models.group_cv(
        d.labelled, ["n_chars", "toxic"], "quality", "source", fit=models.fit_ridge, name="ridge")
    return metrics.fold_summary(metrics.regression_metrics(predicted))


@query
def boosted_round(d):
    """Document quality after one round of boosting with a tree of one split at given edges."""
    edges = {"n_chars": [100.0 * 2 ** i for i in range(8)], "toxic": [0.0]}
    settings = boosting.Settings(rounds=1, max_depth=1, row_share=1.0, column_share=1.0)
    forests, _ = boosting.fit_together(d.labelled, [(list(edges), "quality", -1)], settings, edges=edges)
    return forests[0].transform(d.labelled).select("doc_id", "prediction")


@query
def model_comparison(d):
    """Baseline, tabular, vision and combined model on the same folds."""
    return _comparison(d)[0]


@query
def model_importances(d):
    """Mean feature importance per model of the comparison."""
    return _comparison(d)[1]


@query
def run_rows(d):
    """Rows one comparison run adds to the history tables."""
    table, scores = _comparison(d)
    stamp = F.lit("2024-01-01").cast("timestamp")
    importances = run_importances(scores, stamp).groupBy("model_name").agg(F.count("*").alias("n_importances"))
    return run_metrics(table, stamp).join(importances, "model_name", "left")


@query
def batch_scores(d):
    """Predicted rates for every linked row with models trained on all rows, and what moved them."""
    linked = stash(d.linked, "linked_rows")  # training and scoring share one scan of the log
    matrix, encoders, _ = features.feature_matrix(linked, d.vision, vision_order=("vec_id",))
    fitted = models.fit_targets(matrix)
    rows = linking.attach_vision(linked, d.vision, order=("vec_id",))
    return models.score(rows, fitted, encoders, keep=[*kpi.KEYS, "md5_game_key"], contributions=5)


@query
def ctr_fallback(d):
    """Click-through rate, or a tenth of the engagement rate where it is missing."""
    kpis = kpi.creative_kpis(d.inventory, min_impressions=0, drop_null_keys=False)
    known = F.when(F.col("n_clicks") > 0, F.col("click_through_rate"))
    return kpis.select(*kpi.KEYS, models.ctr_or_share(known, F.col("engagement_rate")).alias("ctr"))
