"""Model fitting, grouped cross-validation, the four-way comparison and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from creascope.functions.cleaning import clip
from creascope.functions.columns import CATEGORICAL_FEATURES, align_columns, feature_sets
from creascope.operators.features import (
    apply_encoders, fill_numbers, fit_encoders, median_fills,
)
from creascope.operators.boosting import Forest, Settings, fit_together
from creascope.operators.folds import assign_group_folds
from creascope.operators.metrics import fold_summary, mean_importance, regression_metrics
from creascope.session import shared_dir, stash

# Settings of Spark's boosted trees, which have no leaf count and no L1/L2 terms.
TREE_SETTINGS = {
    "maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 10,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42,
}
# Target columns, CTR share without a CTR model and the notes of a prediction.
TARGETS = ("engagement_rate", "click_through_rate")
CTR_SHARE = 0.1
NOTE_WITH_IMAGE = "Prediction from multimodal model (tabular + vision)"
NOTE_WITHOUT_IMAGE = "Prediction from tabular-only model (no image provided)"
Model = PipelineModel | Forest
FitFn = Callable[[DataFrame, Sequence[str], str], Model]
PREDICTION_SCHEMA = "model string, fold int, y double, prediction double"
IMPORTANCE_SCHEMA = "model string, fold int, feature string, importance double"


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def fit_trees(df: DataFrame, features: Sequence[str], target: str, **settings) -> PipelineModel:
    """Gradient-boosted trees; lineage is cut every 10 rounds in the shared folder."""
    shared_dir(df.sparkSession)
    trees = GBTRegressor(
        featuresCol="features", labelCol=target, checkpointInterval=10,
        **{**TREE_SETTINGS, **settings})
    return Pipeline(stages=[_assembler(features), trees]).fit(df)


class BoostedTrees:
    """Fits ``boosting`` forests; several models of one table are grown in the same jobs."""

    def __init__(self, **settings):
        self.settings = Settings(**settings)

    def __call__(self, df: DataFrame, features: Sequence[str], target: str) -> Forest:
        return self.together(df, [(features, target, -1)])[0][0]

    def together(self, df: DataFrame, models: Sequence[tuple[Sequence[str], str, int]], fold: str | None = None):
        return fit_together(df, models, self.settings, fold)


fit_boosted = BoostedTrees()


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> PipelineModel:
    """Ridge regression on standardised features: squared error + ``alpha`` * squared weights.

    The solver minimises half the mean squared error and divides ``regParam`` by the deviation
    of the target, hence ``alpha / n`` times that deviation. The scaler divides by the sample
    deviation; ``(n - 1) / n`` makes the penalty the one of features scaled by the population
    deviation.
    """
    n, deviation = df.agg(F.count(target), F.stddev_pop(target)).first()
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled")
    ridge = LinearRegression(
        featuresCol="scaled", labelCol=target, solver="normal", elasticNetParam=0.0,
        standardization=False, regParam=alpha * (n - 1) / (n * n) * deviation)
    return Pipeline(stages=[_assembler(features), scaler, ridge]).fit(df)


def input_columns(model: Model) -> list[str]:
    return list(model.features if isinstance(model, Forest) else model.stages[0].getInputCols())


def importance_list(model: Model, features: Sequence[str]) -> list[tuple[str, float]]:
    """Importance per feature, highest first: splits, tree importance or absolute coefficient."""
    if isinstance(model, Forest):
        return model.importances() if len(model.features) == len(features) else []
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        scores = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        scores = abs(last.coefficients.toArray())
    else:
        return []
    if len(scores) != len(features):
        return []
    pairs = [(name, float(score)) for name, score in zip(features, scores)]
    return sorted(pairs, key=lambda pair: (-pair[1], pair[0]))


def oof_mean(df: DataFrame, target: str, fold: str = "fold") -> DataFrame:
    """Mean baseline: each row predicted by the target mean of the other folds.

    Needs no model: the mean outside a fold follows from one sum and count per fold.
    """
    per_fold = df.groupBy(fold).agg(F.sum(target).alias("s"), F.count(target).alias("c"))
    totals = per_fold.agg(F.struct(F.sum("s").alias("s"), F.sum("c").alias("c"))).scalar()
    means = per_fold.select(fold, F.try_divide(
        totals.getField("s") - F.col("s"), totals.getField("c") - F.col("c")).alias("prediction"))
    # one row per fold
    return df.join(F.broadcast(means), fold).select(
        F.lit("baseline").alias("model"), F.col(fold).alias("fold"),
        F.col(target).cast("double").alias("y"), "prediction")


def _usable(df: DataFrame, target: str, group: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull() & F.col(group).isNotNull())


def _refit_on_train(train: DataFrame, valid: DataFrame, features: Sequence[str]):
    """Category codes and median fills learnt from the training folds only."""
    coded = [name.removesuffix("_enc") for name in features if name.endswith("_enc")]
    raw = [name for name in features if not name.endswith("_enc")]
    drop = [f"{name}_enc" for name in coded]
    train, valid = train.drop(*drop), valid.drop(*drop)
    if coded:
        encoders = stash(fit_encoders(train, coded), "encoders")
        train = apply_encoders(train, encoders, coded, unseen=None)
        valid = apply_encoders(valid, encoders, coded)
    fills = median_fills(train, raw) if raw else {}
    return fill_numbers(train, raw, fills), fill_numbers(valid, raw, fills)


def _cross_validate(
    folded: DataFrame, models: Mapping[str, Sequence[str]], target: str, k: int,
    fit: FitFn, fit_scope: str, parallelism: int,
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold predictions and importances of several models, each named with its features."""
    spark = folded.sparkSession
    if isinstance(fit, BoostedTrees) and fit_scope == "all":
        return _cross_validate_together(folded, models, target, k, fit)

    def run(task: tuple[str, int]):
        name, fold = task
        features = list(models[name])
        used = {*features, *(f.removesuffix("_enc") for f in features), target, "fold"}
        rows = folded.select([c for c in folded.columns if c in used])
        train, valid = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        if fit_scope == "train":
            train, valid = _refit_on_train(train, valid, features)
        else:
            train, valid = train.na.fill(0, features), valid.na.fill(0, features)
        model = fit(train, features, target)
        predicted = model.transform(valid).select(
            F.lit(name).alias("model"), F.col("fold"),
            F.col(target).cast("double").alias("y"), "prediction")
        return predicted, [(name, fold, f, s) for f, s in importance_list(model, features)]

    # all fits are independent: running several at once fills a large cluster
    tasks = [(name, fold) for name in models for fold in range(k)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        results = pool.map(inheritable_thread_target(spark)(run), tasks, chunksize=1)
    predictions = reduce(DataFrame.unionByName, [predicted for predicted, _ in results])
    scores = [row for _, rows in results for row in rows]
    return predictions, spark.createDataFrame(scores, IMPORTANCE_SCHEMA)


def _cross_validate_together(
    folded: DataFrame, models: Mapping[str, Sequence[str]], target: str, k: int, fit: BoostedTrees,
) -> tuple[DataFrame, DataFrame]:
    """All models and folds in the same jobs; a row's out-of-fold score is kept where its fold is left out."""
    tasks = [(name, fold) for name in models for fold in range(k)]
    forests, scores = fit.together(folded, [(list(models[name]), target, fold) for name, fold in tasks], "fold")
    labels = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(fold).alias("left_out")) for name, fold in tasks])
    zipped = scores.select("fold", F.col("y")[0].alias("y"), F.explode(F.arrays_zip(labels.alias("l"), "score")).alias("z"))
    predictions = zipped.filter("z.l.left_out = fold").select(
        F.col("z.l.model").alias("model"), "fold", "y", F.col("z.score").alias("prediction"))
    rows = [(name, fold, f, s) for (name, fold), forest in zip(tasks, forests) for f, s in forest.importances()]
    return predictions, folded.sparkSession.createDataFrame(rows, IMPORTANCE_SCHEMA)


def group_cv(
    df: DataFrame, features: Sequence[str], target: str, group: str, fit: FitFn = fit_boosted,
    k: int = 5, name: str = "model", fit_scope: str = "all", parallelism: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold predictions and per-fold importances of one model.

    ``fit_scope="all"`` takes the features as they are, missing ones as 0; ``"train"`` learns
    category codes and median fills from the training folds.
    """
    clean = _usable(df, target, group)
    rows = clean.count()
    if rows < 2 * k:
        raise ValueError(f"insufficient_data: {rows} rows for {k} folds")
    folded = stash(assign_group_folds(clean, group, k), "folds")
    return _cross_validate(folded, {name: features}, target, k, fit, fit_scope, parallelism)


def benchmark(
    feature_df: DataFrame, target: str = TARGETS[0], group: str = "campaign_id", k: int = 5,
    fit: FitFn = fit_boosted, fit_scope: str = "all", parallelism: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Baseline, tabular, vision and combined model on the same folds.

    Returns one summary row per model (with an ``error`` text and no metrics for a model that
    could not be run) and the mean feature importances. For ``fit_scope="train"`` pass the
    linked rows with image columns, not yet encoded or filled.
    """
    spark = feature_df.sparkSession
    if fit_scope == "train":
        uncoded = [name for name in CATEGORICAL_FEATURES
                   if name in feature_df.columns and f"{name}_enc" not in feature_df.columns]
        feature_df = feature_df.withColumns(
            {f"{name}_enc": F.lit(None).cast("int") for name in uncoded})
    sets = feature_sets(feature_df)
    sizes = {"baseline": 1} | {name: len(features) for name, features in sets.items()}
    models = spark.createDataFrame(
        [(name, n, None if n else "no_features") for name, n in sizes.items()],
        "model string, n_features long, error string")
    clean = _usable(feature_df, target, group)
    folded = stash(assign_group_folds(clean, group, k), "folds")
    importances = spark.createDataFrame([], IMPORTANCE_SCHEMA)
    if folded.count() < 2 * k:
        models = models.withColumn("error", F.lit("insufficient_data"))
        predictions = spark.createDataFrame([], PREDICTION_SCHEMA)
    else:
        predictions = oof_mean(folded, target)
        runnable = {name: features for name, features in sets.items() if features}
        if runnable:
            predicted, importances = _cross_validate(
                folded, runnable, target, k, fit, fit_scope, parallelism)
            predictions = predictions.unionByName(predicted)
    summary = fold_summary(regression_metrics(predictions))
    campaigns = folded.agg(F.count_distinct(group)).scalar()
    table = models.join(summary, "model", "left").withColumns({
        "target_metric": F.lit(target), "n_train_campaigns": campaigns})
    return table, mean_importance(importances, k)


def fit_targets(
    feature_df: DataFrame, targets: Sequence[str] = TARGETS, fit: FitFn = fit_boosted,
    features: Sequence[str] | None = None,
) -> dict[str, Model]:
    """One model per target column, each on the rows where that target is known."""
    features = list(features or feature_sets(feature_df)["multimodal"])
    rows = stash(feature_df.select(*features, *[t for t in targets if t in feature_df.columns])
                 .na.fill(0, features), "training")
    present = [target for target in targets if target in rows.columns]
    if isinstance(fit, BoostedTrees):
        forests, _ = fit.together(rows, [(features, target, -1) for target in present])
        return dict(zip(present, forests))
    return {
        target: fit(rows.filter(F.col(target).isNotNull()), features, target)
        for target in present
    }


def ctr_or_share(ctr: Column | None, er: Column) -> Column:
    """Predicted CTR, otherwise a tenth of the engagement rate, otherwise 0."""
    choices = ([] if ctr is None else [ctr]) + [er * CTR_SHARE, F.lit(0.0)]
    return F.coalesce(*choices)


def score(
    df: DataFrame, models: Mapping[str, Model], encoders: DataFrame,
    keep: Sequence[str] = ("game_key",), contributions: int = 0,
) -> DataFrame:
    """Predicted rates for a table of creatives.

    Categories are encoded with the training dictionaries, unknown columns and NULLs become 0
    and predictions are bounded to [0, 1]. Needs the engagement model; without a CTR model a
    share of the engagement rate is used. ``contributions`` adds so many features with what they moved
    the engagement rate by (``feature_contributions``), largest first; it needs boosted trees.
    """
    er_model, ctr_model = models["engagement_rate"], models.get("click_through_rate")
    features = input_columns(er_model)
    coded = [name.removesuffix("_enc") for name in features if name.endswith("_enc")]
    encoded = apply_encoders(df, encoders, coded, unseen="zero")
    seen = [F.col(name).isNotNull() for name in feature_sets(df)["vision"]]
    has_image = reduce(Column.__or__, seen, F.lit(False))
    rows = align_columns(encoded.withColumn("vision_features_used", has_image), features,
                         keep=[*keep, "vision_features_used"])
    scored = er_model.transform(rows).withColumn(
        "engagement_rate_predicted", clip(F.col("prediction"), 0.0, 1.0)
    ).drop(*_outputs(er_model))
    moved = []
    if contributions:
        scored = er_model.contributions(scored, "feature_contributions", contributions)
        moved = ["feature_contributions"]
    ctr = None
    if ctr_model is not None:
        scored = ctr_model.transform(scored).withColumn("_ctr", clip(F.col("prediction"), 0.0, 1.0))
        ctr = F.col("_ctr")
    note = F.when(F.col("vision_features_used"), NOTE_WITH_IMAGE).otherwise(NOTE_WITHOUT_IMAGE)
    return scored.select(
        *keep, "vision_features_used", "engagement_rate_predicted",
        ctr_or_share(ctr, F.col("engagement_rate_predicted")).alias("click_through_rate_predicted"),
        note.alias("confidence_note"), *moved)


def _outputs(model: Model) -> list[str]:
    if isinstance(model, Forest):
        return ["prediction"]
    return [stage.getOutputCol() for stage in model.stages[:-1]] + ["prediction"]


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    if isinstance(model, Forest):
        model.save(spark, f"{path}/forest")
    else:
        model.write().overwrite().save(f"{path}/pipeline")


def load_model(spark: SparkSession, path: str, kind: str) -> Model:
    """``kind`` is ``forest`` or ``pipeline``, as ``model_kind`` names it."""
    return Forest.load(spark, f"{path}/forest") if kind == "forest" else PipelineModel.load(f"{path}/pipeline")


def model_kind(model: Model) -> str:
    return "forest" if isinstance(model, Forest) else "pipeline"
