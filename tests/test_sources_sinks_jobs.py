import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from creascope.operators import models, reports
from creascope.plans import jobs
from creascope.plans.binding import Domain
from creascope.plans.catalog import QUERIES
from creascope.sinks import tables
from creascope.sources import files

FOLDER = "/root/testdata/sf0.01"


def test_event_log_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'Campaign ID,Game Key,Type,Browser TS\nc1,"s,1/r"," Impression ",2021-03-04 05:06:07\n,s/r,NA,yesterday\n')
    (tmp_path / "b.csv").write_text('Campaign ID,Game Key,Type,Browser TS\nc2,"say ""hi""/r",Swipe,\n')
    rows = {r.game_key: r for r in files.read_inventory(spark, str(tmp_path)).collect()}
    assert rows["s,1/r"].type == "impression" and rows["s,1/r"].browser_ts == dt.datetime(2021, 3, 4, 5, 6, 7)
    assert rows["s/r"].campaign_id is None and rows["s/r"].type is None and rows["s/r"].browser_ts is None
    assert rows['say "hi"/r'].type == "swipe"


def test_briefing_from_csv(spark, tmp_path):
    (tmp_path / "briefing.csv").write_text("Campaign_ID,Submission Date,Buy Rate (CPE),StartDate\nc1,1/2/2021,0.4,05/06/2021\n")
    from creascope.operators.linking import campaigns
    row = campaigns(files.read_briefing(spark, str(tmp_path / "briefing.csv"))).first()
    assert (row.campaign_id, row.buy_rate_cpe, row.startdate) == ("c1", 0.4, dt.datetime(2021, 6, 5))


def test_briefing_with_line_breaks(spark, tmp_path):
    (tmp_path / "briefing.csv").write_text('Campaign_ID,KPIs\nc1,"reach\nand ""recall"""\nc2,clicks\n')
    rows = files.read_briefing(spark, str(tmp_path / "briefing.csv")).collect()
    assert [tuple(r) for r in rows] == [("c1", 'reach\nand "recall"'), ("c2", "clicks")]


@pytest.mark.parametrize("name", ["linked_from_warehouse", "dashboard_stats"])
def test_warehouse_reports_leave_the_images_alone(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "n_impressions" in plan and "embedding" not in plan


def test_palette(spark, tmp_path):
    record = {"text": {"engagement": ["A"], "click_through": {"(0, 0, 0)": 0.5}},
              "colors": {"engagement": {"(80, 96, 115)": 0.25, "(0, 0, 0)": 0.5}, "click_through": {"(1, 2, 3)": 0.1}},
              "videos_data": {"has_video": 0}}
    doc = [{"Creative Assets_\\adunit-x-mob": {"id1": record, "bad": 3}}, {"plain": {"id2": {"colors": {}}}}]
    (tmp_path / "palette.json").write_text(json.dumps(doc, indent=1))
    rows = [tuple(r) for r in files.read_palette(spark, str(tmp_path / "palette.json")).collect()]
    assert sorted(rows) == [
        ("adunit-x-mob", "id1", "click_through", 1, 2, 3, 0.1),
        ("adunit-x-mob", "id1", "engagement", 0, 0, 0, 0.5),
        ("adunit-x-mob", "id1", "engagement", 80, 96, 115, 0.25)]


def test_benchmark_document(spark, tmp_path):
    doc = {"target": "engagement_rate", "models": {
        "baseline": {"mae_mean": 0.1, "rmse_mean": 0.2, "r2_mean": -0.1, "mape_mean": 10.0, "n_features": 1},
        "tabular": {"mae_mean": 0.05, "feature_importance": {"brightness": 3.0, "buy_rate_cpe": 2.5}, "n_features": 2},
        "vision": {"error": "no_features"}}}
    (tmp_path / "results.json").write_text(json.dumps(doc, indent=1))
    metrics, importances = files.read_benchmark(spark, str(tmp_path / "results.json"))
    rows = {r.model_name: r for r in metrics.collect()}
    assert set(rows) == {"baseline", "tabular"} and rows["tabular"].rmse == 0.0 and rows["tabular"].n_features == 2
    assert {(r.feature_name, r.importance_score, r.category) for r in importances.collect()} == {
        ("brightness", 3.0, "Visual"), ("buy_rate_cpe", 2.5, "Contextual")}


def test_writing_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    assert not tables.exists(spark, path)
    assert tables.write_if_empty(df.limit(0), path) == 0
    assert tables.write_if_empty(df, path) == 10  # an empty table is loaded
    assert tables.write_if_empty(df, path) is None  # a filled one is not
    assert tables.write_table(df.withColumn("x", F.lit(1)), path) == 10  # replaced with a new schema
    assert tables.read_table(spark, path).columns == ["id", "x"]
    assert tables.write_table(df.limit(3).withColumn("x", F.lit(2)), path, mode="append") == 3
    assert tables.read_table(spark, path).count() == 13


def test_cache_or_compute(spark, tmp_path):
    path, calls = str(tmp_path / "cached"), []

    def compute():
        calls.append(1)
        return spark.range(len(calls))

    assert tables.materialize(spark, path, compute).count() == 1
    assert tables.materialize(spark, path, compute).count() == 1
    assert tables.materialize(spark, path, compute, force=True).count() == 2


def test_run_history_is_kept(spark, tmp_path):
    models_ = spark.createDataFrame(
        [("baseline", "engagement_rate", 0.1, None, 1, None), ("vision", "engagement_rate", None, None, 0, "no_features")],
        "model string, target_metric string, mae_mean double, rmse_mean double, n_features int, error string"
    ).withColumns({"r2_mean": F.lit(0.2), "mape_mean": F.lit(5.0)})
    importances = spark.createDataFrame([("baseline", "brightness", 1.0)], "model string, feature string, importance double")
    for day in (1, 2):
        tables.append_run(models_, importances, str(tmp_path), F.lit(dt.datetime(2024, 1, day)))
    history = tables.read_run(spark, str(tmp_path), "model_benchmarks")
    assert history.count() == 2 and history.first().rmse == 0.0
    latest = reports.latest_run(history).collect()
    assert [r.run_timestamp.day for r in latest] == [2]


def test_half_a_run_is_not_read_and_a_repeated_run_replaces(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path), tables.write_table
    models_ = spark.createDataFrame(
        [("baseline", "engagement_rate", 0.1, 0.2, 0.3, 5.0, 3)],
        "model string, target_metric string, mae double, rmse double, r2 double, mape double, n_features int")
    importances = spark.createDataFrame(
        [("baseline", "brightness", 1.0)], "model string, feature string, importance double")

    def counts():
        return [tables.read_run(spark, root, name).count() for name in ("model_benchmarks", "feature_importances")]

    def broken_at(part):
        def fail(df, path, mode="overwrite"):
            if path.endswith(part):
                raise OSError("lost")
            return write(df, path, mode)
        return fail

    first, second = (F.lit(dt.datetime(2024, 1, day)) for day in (1, 2))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_table", broken_at("runs"))
        with pytest.raises(OSError):
            tables.append_run(models_, importances, root, first)
    assert counts() == [0, 0]  # nothing was ever committed
    tables.append_run(models_, importances, root, first)
    assert counts() == [1, 1]
    for part in ("feature_importances", "runs"):
        with monkeypatch.context() as patch:
            patch.setattr(tables, "write_table", broken_at(part))
            with pytest.raises(OSError):
                tables.append_run(models_, importances, root, second)
        assert counts() == [1, 1]
    for mae in (0.7, 0.9):  # the same run twice
        tables.append_run(models_.withColumn("mae", F.lit(mae)), importances, root, second)
    assert counts() == [2, 2]
    rows = tables.read_run(spark, root, "model_benchmarks").orderBy("run_timestamp").collect()
    assert [r.mae for r in rows] == [0.1, 0.9] and "attempt" not in rows[0].asDict()


@pytest.mark.parametrize("er, tier", [
    (0.0799, "low"), (0.08, "avg"), (0.12, "avg"), (0.1201, "high"), (0.15, "high"), (0.1501, "top")])
def test_tier_boundaries(one, er, tier):
    assert one(reports.tier(F.lit(er))) == [tier]


def test_heuristic_score(spark):
    row = spark.createDataFrame([("smartphone", "iOS", "USA", 0.4, 50.0, 40.0, 30.0, True)],
        "device string, os string, region string, cpe double, brightness double, saturation double, colorfulness double, has_video boolean")
    er = 0.12 * 1.15 * 1.08 * 1.10 * (1 - 0.12) * 1.0 * 0.97 * 0.96 * 1.12
    got = reports.heuristic_score(row).first()
    assert got.er_percent == round(er * 100, 1) and got.ctr_percent == round(er * 45, 1)
    assert er > 0.15 and got.tier == "top" and got.tier_label.endswith("Top Performer")


def test_stats_of_empty_tables(spark):
    metrics = spark.createDataFrame([], "n_impressions long")
    none = spark.createDataFrame([], "x int")
    runs = spark.createDataFrame([], "run_timestamp timestamp, model_name string, r2 double")
    assert tuple(reports.dashboard_stats(metrics, none, none, runs).first()) == (0, 0, 0, 0.0)


def short(df, names, target):
    return models.fit_trees(df, names, target, maxIter=2, maxDepth=2)


def test_jobs_end_to_end(spark, tmp_path):
    d, out = Domain(spark, FOLDER), str(tmp_path)
    loaded = jobs.load_staging(
        spark, out, inventory=d.inventory, briefing=d.raw_briefing, design_docs=d.design_docs,
        assets=d.assets, vision=d.vision.drop("vec_id"))
    assert loaded["raw_inventory"] == 10_000 and loaded["raw_design_metadata"] == 200
    assert jobs.load_staging(spark, out, inventory=d.inventory)["raw_inventory"] is None
    built = jobs.build_warehouse(spark, out, tie=["submission_id"])
    assert built["campaigns"] == d.campaigns.count() and built["creatives"] == 18
    assert built["creative_metrics"] + built["creative_metrics_orphans"] == d.metrics.count()
    assert built["creative_metrics_orphans"] > 0
    with pytest.raises(ValueError, match="briefing"):
        jobs.build_warehouse(spark, out, tie=["submission_id"], on_orphans="fail")

    assert jobs.write_legacy_design(d.design_docs, f"{out}/legacy_design") == 200
    linked = jobs.linked_table(spark, out)
    first = jobs.build_features(spark, out)
    assert first.count() == linked.count() and not first.isEmpty()
    table, _ = jobs.run_benchmark(spark, out, fit=short, k=3)
    assert table.count() == 4
    assert tables.read_table(spark, f"{out}/model_benchmarks").count() == 4
    assert spark.read.json(f"{out}/benchmark_results.json").count() == 4

    jobs.train_final(first, tables.read_table(spark, f"{out}/encoders"), out, fit=short)
    scored = jobs.score_batch(linked, out, keep=["campaign_id", "game_key"])
    assert scored.count() == linked.count()
    assert scored.filter("engagement_rate_predicted < 0 or engagement_rate_predicted > 1").isEmpty()


def test_entry_and_registry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
