import math
import random
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from creascope.operators import features, folds, metrics, models


def test_codes_follow_sorted_order_and_round_trip(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4)], "device_type string, n int")
    enc = features.fit_encoders(df).cache()
    assert [tuple(r) for r in enc.orderBy("code").collect()] == [
        ("device_type", "a", 0), ("device_type", "b", 1), ("device_type", "unknown", 2)]
    coded = features.apply_encoders(df, enc, unseen=None)
    back = coded.join(enc, F.col("device_type_enc") == F.col("code"))
    assert back.filter("device_type <> value").isEmpty() and back.count() == 4
    assert {"geo_country", "platform_os"} <= set(coded.columns) and "geo_country_enc" not in coded.columns
    assert coded.first().geo_country == "unknown"


def test_unseen_categories(spark):
    seen = features.fit_encoders(spark.createDataFrame([("a",), ("b",)], "c string"), ["c"])
    with_unknown = features.fit_encoders(spark.createDataFrame([("a",), (None,), ("z",)], "c string"), ["c"])
    new = spark.createDataFrame([("a",), ("x",)], "c string")

    def codes(enc, **options):
        return {r.c: r.c_enc for r in features.apply_encoders(new, enc, ["c"], **options).collect()}

    assert codes(seen) == {"a": 0, "unknown": 2}
    assert codes(seen, unseen="zero") == {"a": 0, "unknown": 0}
    assert codes(with_unknown) == {"a": 0, "unknown": 1}
    assert codes(with_unknown, unseen="zero") == {"a": 0, "unknown": 1}
    assert codes(seen.filter("false")) == {"a": 0, "x": 0}


@pytest.mark.parametrize("accuracy, buckets", [(10_000, 1_000), (10, 3), (10, 1)])
def test_medians_are_exact(spark, accuracy, buckets):
    rng = random.Random(7)
    shapes = {
        "even": [rng.gauss(0, 1) for _ in range(400)],
        "hot": [5.0] * 150 + [rng.random() * 100 for _ in range(250)],
        "wide": [10 ** rng.uniform(-9, 9) for _ in range(400)],
        "few": [1.0, 2.0] * 200,
    }
    rows = [tuple(values) for values in zip(*shapes.values())]
    odd = rows[:-1] + [(None, float("nan"), None, None)]
    for data in (rows, odd):
        df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in shapes)).withColumn("none", F.lit(None).cast("double"))
        names = [*shapes, "none"]
        found = {r.feature: r.median for r in features.column_medians(df, names, accuracy=accuracy, buckets=buckets).collect()}
        for i, name in enumerate(shapes):
            values = [r[i] for r in data if r[i] is not None and not math.isnan(r[i])]
            assert found[name] == statistics.median(values), name
        assert "none" not in found
    assert features.median_fills(df, ["few", "none"], approx=True)["none"] == 0.0


@pytest.mark.parametrize("hold", [1, 7, 60])
def test_medians_refine_until_few_values_are_held(spark, hold):
    """Clustered, tied, mirrored and skewed columns; more values than may be held at once."""
    rng = random.Random(9)
    n = 3001
    shapes = {
        "clustered": [1e6 + rng.random() * 1e-3 for _ in range(n - 2)] + [-1e12, 1e12],
        "two": [0.0] * (n // 2) + [1.0] * (n - n // 2),
        "steps": [float(rng.randrange(9)) for _ in range(n)],
        "signs": [rng.choice([-1, 1]) * 10 ** rng.uniform(-5, 5) for _ in range(n)],
        "whole": [float(i * 7919 % n) for i in range(n)],
    }
    df = spark.createDataFrame(list(zip(*shapes.values())), ", ".join(f"{s} double" for s in shapes))
    for rows in (df, df.limit(n - 1)):
        found = {r.feature: r.median for r in features.column_medians(rows, list(shapes), buckets=10, hold=hold).collect()}
        taken = list(zip(*rows.collect()))
        for i, shape in enumerate(shapes):
            assert found[shape] == statistics.median(taken[i]), shape


def test_codes_of_many_values(spark):
    values = [f"v{i * 7919 % 40_009}" for i in range(40_009)] + ["é", "", " "]
    df = spark.createDataFrame([(v, f"w{i % 3}") for i, v in enumerate(values)], "a string, b string").repartition(6)
    codes = features.fit_encoders(df, ["a", "b"])
    plan = codes._jdf.queryExecution().executedPlan().toString()
    got = {(r["column"], r["value"]): r["code"] for r in codes.collect()}
    expected = sorted({r.value for r in codes.filter("column = 'a'").select("value").distinct().collect()})
    assert [got["a", v] for v in expected] == list(range(len(expected)))
    assert [got["b", f"w{i}"] for i in range(3)] == [0, 1, 2]
    # no window over a whole column
    windows = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert any(w.startswith("column") and ", part" in w for w in windows)


def test_feature_matrix_fit_and_apply(spark):
    linked = spark.createDataFrame(
        [("a.png", "ios", 1.0, 2.0), ("b.png", None, None, 4.0), ("c.png", "android", 3.0, None)],
        "image_filename string, platform_os string, buy_rate_cpe double, aspect_ratio double")
    vision = spark.createDataFrame([("a.png", 0.4), ("b.png", 0.6)], "filename string, brightness_mean double")
    fitted, enc, fills = features.feature_matrix(linked, vision)
    rows = {r.image_filename: r for r in fitted.collect()}
    assert [rows[f"{k}.png"].platform_os_enc for k in "abc"] == [1, 2, 0]
    assert rows["b.png"].buy_rate_cpe == 2.0 and rows["c.png"].aspect_ratio == 3.0
    assert rows["c.png"].brightness_mean == 0.5 and fills["buy_rate_cpe"] == 2.0
    applied, _, _ = features.feature_matrix(linked.withColumn("platform_os", F.lit("new")), vision, encoders=enc)
    rows = {r.image_filename: r for r in applied.collect()}
    assert rows["b.png"].buy_rate_cpe == 0.0 and rows["a.png"].platform_os_enc == 2


def test_folds_keep_groups_together_and_balanced(spark):
    sizes = {f"g{i}": n for i, n in enumerate([300, 90, 80, 70, 60, 50, 50, 40, 30, 20, 10, 5])} | {None: 45}
    rows = [(g, i) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int")
    placed = folds.assign_group_folds(df, "g", 5)
    by_group = {r.g: r for r in placed.groupBy("g").agg(
        F.min("fold").alias("lo"), F.max("fold").alias("hi"), F.count("*").alias("n")).collect()}
    assert all(r.lo == r.hi and 0 <= r.lo < 5 for r in by_group.values())
    assert {g: r.n for g, r in by_group.items()} == sizes  # no row lost
    # largest first, to and fro; the two groups of 50 may change places
    assert [by_group[g].lo for g in ("g0", "g1", "g2", "g3", "g4")] == [0, 1, 2, 3, 4]
    assert {by_group["g5"].lo, by_group["g6"].lo} == {4, 3}
    assert [by_group[g].lo for g in (None, "g7", "g8", "g9", "g10", "g11")] == [2, 1, 0, 0, 1, 2]
    hashed = folds.assign_group_folds(df, "g", 5, method="hash")
    assert hashed.groupBy("g").agg(F.count_distinct("fold").alias("d")).filter("d > 1").isEmpty()


def test_fold_rule_is_the_same_for_many_groups(spark):
    df = spark.range(400_000).selectExpr("cast(sqrt(id) * 400 as long) as g")
    rows = folds.assign_group_folds(df, "g", 5).groupBy("fold").agg(
        F.count("*").alias("n"), F.count_distinct("g").alias("groups")).collect()
    largest = df.groupBy("g").count().agg(F.max("count")).first()[0]
    assert len(rows) == 5 and sum(r.n for r in rows) == 400_000 and sum(r.groups for r in rows) > 150_000
    assert max(r.n for r in rows) - min(r.n for r in rows) <= largest
    assert max(r.groups for r in rows) - min(r.groups for r in rows) <= 1


def one_metric(spark, pairs):
    df = spark.createDataFrame([("m", 0, float(y), float(p)) for y, p in pairs], models.PREDICTION_SCHEMA)
    return metrics.regression_metrics(df).first()


def test_metric_edge_cases(spark):
    r = one_metric(spark, [(1, 1.5), (2, -1), (0, 0.5)])
    assert r.mae == pytest.approx((0.5 + 2 + 0.5) / 3) and r.rmse == pytest.approx(math.sqrt(4.5 / 3))
    assert r.mape == pytest.approx(75.0) and r.r2 == pytest.approx(1 - 4.5 / 2)
    assert one_metric(spark, [(2, 2), (2, 2)]).r2 == 1.0
    assert one_metric(spark, [(2, 2), (2, 3)]).r2 == 0.0
    assert math.isnan(one_metric(spark, [(0, 1), (0, 2)]).mape)
    assert math.isnan(one_metric(spark, [(1, 1)]).r2)
    folds_ = spark.createDataFrame([("m", 0, 0.0, 1.0), ("m", 0, 0.0, 2.0), ("m", 1, 1.0, 1.0), ("m", 1, 2.0, 1.0)],
                                   models.PREDICTION_SCHEMA)
    assert math.isnan(metrics.fold_summary(metrics.regression_metrics(folds_)).first().mape_mean)


def test_out_of_fold_mean(spark):
    rng = random.Random(3)
    rows = [(i % 4, rng.random()) for i in range(50)]
    predicted = models.oof_mean(spark.createDataFrame(rows, "fold int, y double"), "y")
    for r in predicted.select("fold", "prediction").distinct().collect():
        assert r.prediction == pytest.approx(np.mean([y for f, y in rows if f != r.fold]))


def regression_rows(spark, n=120):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [0, 5, 1]
    y = 0.3 + x @ [0.05, 0.01, 0.5] + rng.normal(scale=0.05, size=n)
    rows = [(f"c{i % 12}", *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "campaign_id string, a double, b double, c double, y double"), x, y


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_ridge_equals_closed_form(spark, alpha):
    df, x, y = regression_rows(spark)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    weights = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
    model = models.fit_ridge(df, ["a", "b", "c"], "y", alpha)
    got = [r.prediction for r in model.transform(df).select("prediction").collect()]
    assert got == pytest.approx(list(y.mean() + z @ weights), abs=1e-8)
    assert {n for n, _ in models.importance_list(model, ["a", "b", "c"])} == {"a", "b", "c"}
    assert models.importance_list(model, ["a"]) == []


def short(df, names, target):
    return models.fit_trees(df, names, target, maxIter=3, maxDepth=2, minInstancesPerNode=1)


def test_group_cv_predicts_every_row_once(spark):
    df, _, y = regression_rows(spark)
    predictions, importances = models.group_cv(df, ["a", "b", "c"], "y", "campaign_id", fit=short)
    rows = predictions.collect()
    assert sorted(r.y for r in rows) == pytest.approx(sorted(y))
    assert {r.fold for r in rows} == set(range(5)) and importances.count() == 15
    total = metrics.mean_importance(importances, 5).agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)
    with pytest.raises(ValueError, match="insufficient_data"):
        models.group_cv(df.limit(9), ["a"], "y", "campaign_id", fit=short)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(1)
    rows = [(f"c{i % 10}", f"g{i}", rng.choice(["ios", "android", None]), rng.random(), rng.random(),
             None if i % 17 == 0 else rng.random(), None if i % 13 == 0 else 0.1) for i in range(100)]
    return spark.createDataFrame(
        rows, "campaign_id string, game_key string, platform_os string, buy_rate_cpe double, "
        "brightness_mean double, engagement_rate double, click_through_rate double").cache()


@pytest.mark.parametrize("scope", ["all", "train"])
def test_benchmark_compares_four_models(spark, matrix, scope):
    df = matrix if scope == "train" else features.feature_matrix(matrix)[0]
    table, importances = models.benchmark(df, fit=short, fit_scope=scope)
    rows = {r.model: r for r in table.collect()}
    assert set(rows) == {"baseline", "tabular", "vision", "multimodal"}
    assert {m: r.n_features for m, r in rows.items()} == {"baseline": 1, "tabular": 2, "vision": 1, "multimodal": 3}
    assert all(r.error is None and r.n_folds == 5 and r.mae_mean > 0 for r in rows.values())
    assert rows["baseline"].n_train_campaigns == 10
    assert {r.model for r in importances.collect()} == {"tabular", "vision", "multimodal"}


def test_benchmark_reports_what_it_cannot_run(spark, matrix):
    tabular_only = features.feature_matrix(matrix.drop("brightness_mean"))[0]
    rows = {r.model: r for r in models.benchmark(tabular_only, fit=short)[0].collect()}
    assert rows["vision"].error == "no_features" and rows["vision"].mae_mean is None
    assert rows["tabular"].error is None
    few = models.benchmark(tabular_only.limit(5), fit=short)[0]
    assert {r.error for r in few.collect()} == {"insufficient_data"}


def test_scoring(spark, matrix):
    df, encoders, _ = features.feature_matrix(matrix)
    fitted = models.fit_targets(df, fit=short)
    new = spark.createDataFrame([("n1", "ios", 0.4, 0.5), ("n2", "palm", None, None)],
                                "game_key string, platform_os string, buy_rate_cpe double, brightness_mean double")
    rows = {r.game_key: r for r in models.score(new, fitted, encoders).collect()}
    assert set(rows) == {"n1", "n2"}
    assert all(0 <= r.engagement_rate_predicted <= 1 and 0 <= r.click_through_rate_predicted <= 1 for r in rows.values())
    assert rows["n1"].vision_features_used and not rows["n2"].vision_features_used
    assert "tabular-only" in rows["n2"].confidence_note
    no_ctr = models.score(new, {"engagement_rate": fitted["engagement_rate"]}, encoders).first()
    assert no_ctr.click_through_rate_predicted == pytest.approx(no_ctr.engagement_rate_predicted * 0.1)


def test_correlations_sorted(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 2.0, 2.0), (3.0, 1.0, None), (4.0, 0.0, 4.0)], "a double, b double, y double")
    got = metrics.target_correlations(df, ["b", "a"], "y").collect()
    assert [(r.feature, round(r.correlation, 9)) for r in got] == [("a", 1.0), ("b", -1.0)]
