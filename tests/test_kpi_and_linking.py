import datetime as dt

import pytest
from pyspark.sql import functions as F

from creascope.operators import kpi, linking

SCHEMA = "campaign_id string, game_key string, device_type string, platform_os string, geo_country string, type string"


# events per context: (campaign, game key, device, system, country, {type: how many})
CONTEXTS = [
    ("spring", "banner/r1", "tablet", "windows", "DE", {"impression": 3, "first_dropped": 1}),
    ("spring", "banner/r1", "tablet", "linux", "FR", {"impression": 2, "first_dropped": 1, "click-through-event": 1}),
    ("summer", "video/r2", "desktop", "windows", "DE", {"impression": 2}),
    ("summer", "video/r2", "desktop", "linux", "DE", {"impression": 1, "first_dropped": 1}),
    ("summer", "video/r2", None, "linux", "DE", {"impression": 1}),
    (None, "video/r2", "desktop", "linux", "DE", {"impression": 1}),
    ("summer", "noslash", "desktop", "linux", "DE", {"impression": 1}),
    ("winter", "x/y/r3", "desktop", "linux", "DE", {"first_dropped": 1, "swipe": 1, None: 1}),
]


def events(spark):
    return spark.createDataFrame(
        [(*context, kind) for *context, kinds in CONTEXTS for kind, n in kinds.items() for _ in range(n)], SCHEMA)


def test_rates_lie_between_0_and_1(spark):
    rows = kpi.creative_kpis(events(spark), min_impressions=1).collect()
    assert rows and all(0 <= r[c] <= 1 for r in rows for c in ("engagement_rate", "click_through_rate"))
    first = [r for r in rows if r.campaign_id == "spring" and r.game_key == "banner/r1"]
    assert max(r.engagement_rate for r in first) == 0.5
    assert {(r.creative_slug, r.creative_request_id) for r in first} == {("banner", "r1")}


def test_minimum_impressions(spark):
    assert kpi.creative_kpis(events(spark), min_impressions=100).isEmpty()
    assert kpi.creative_kpis(events(spark)).isEmpty()


def test_null_keys(spark):
    dropped = kpi.creative_kpis(events(spark), min_impressions=0).collect()
    kept = kpi.creative_kpis(events(spark), min_impressions=0, drop_null_keys=False, clipped=False).collect()
    assert len(kept) - len(dropped) == 3
    zero = next(r for r in dropped if r.campaign_id == "winter")
    assert (zero.n_impressions, zero.n_engagements, zero.engagement_rate) == (0, 1, None)
    assert (zero.creative_slug, zero.creative_request_id) == ("x/y", "r3")


@pytest.mark.parametrize("keep", [["swipe"], "all"])
def test_other_types_become_columns(spark, keep):
    rows = kpi.creative_kpis(events(spark), min_impressions=0, keep_types=keep).collect()
    assert sum(r.swipe for r in rows) == 1


def test_map_of_types_equals_the_pivot(spark):
    many = events(spark).unionByName(events(spark).withColumn("type", F.concat(F.lit("kind"), F.monotonically_increasing_id())))
    pivoted = kpi.creative_kpis(many, min_impressions=0, keep_types="all").collect()
    mapped = {tuple(r[k] for k in kpi.KEYS): r for r in kpi.creative_kpis(many, min_impressions=0, keep_types="map").collect()}
    assert len(pivoted) == len(mapped)
    for r in pivoted:
        m = mapped[tuple(r[k] for k in kpi.KEYS)]
        assert all(m[n] == r[n] for n in ("n_impressions", "n_engagements", "n_clicks", "engagement_rate"))
        others = {k: v for k, v in m["type_counts"].items() if k not in kpi.EVENT_COUNTS}
        assert others == {c: r[c] for c in r.asDict() if c.startswith(("kind", "swipe", "other")) and r[c]}
    assert kpi.creative_kpis(many.limit(0), min_impressions=0, keep_types="map").count() == 0


def test_pivot_adds_absent_types(spark):
    only = events(spark).filter("type = 'impression'")
    row = kpi.creative_kpis(only, min_impressions=1, keep_types="all").first()
    assert (row.n_engagements, row.n_clicks, row.engagement_rate) == (0, 0, 0.0)


def test_missing_context_columns_are_not_grouped_by(spark):
    slim = kpi.creative_kpis(events(spark).drop("device_type"), min_impressions=1)
    assert "device_type" not in slim.columns and not slim.isEmpty()


def test_warehouse_metrics(spark):
    inventory = events(spark)
    creatives = spark.createDataFrame([("video/r2",)], "game_key string")
    rows = kpi.creative_metrics(inventory, creatives).collect()
    assert {r.game_key for r in rows} == {"video/r2"} and len(rows) == 3
    assert any(r.device_type is None for r in rows)
    unfiltered = kpi.creative_metrics(inventory).filter("campaign_id = 'winter'").first()
    assert unfiltered.engagement_rate is None


def test_campaign_kpis_do_not_carry_over(spark):
    rows = {r.campaign_id: r for r in kpi.campaign_kpis(events(spark)).collect()}
    assert (rows["spring"].ER, rows["spring"].CTR) == pytest.approx((40.0, 20.0))
    assert rows["summer"].CTR == 0.0 and rows["winter"].ER is None


def test_value_counts(spark):
    top = kpi.value_counts(events(spark), "game_key", 2).collect()
    assert [tuple(r) for r in top] == [("banner/r1", 8), ("video/r2", 6)]


BRIEFING = "campaign_id string, submission_date string, n int, startdate string, enddate string, buy_rate_cpe string, kpis string"


@pytest.fixture
def briefing(spark):
    return spark.createDataFrame([
        ("c1", "02/01/2021", 1, "01/02/2021", "05/02/2021", "0.5", "old"),
        ("c1", "10/01/2021", 2, "03/02/2021", "01/02/2021", "tbc", "new"),
        ("c1", "10/01/2021", 1, "04/02/2021", "09/02/2021", "0.7", "tie"),
        ("c2", "unknown", 5, "soon", "05/02/2021", None, "undated"),
        ("c2", "01/01/2020", 1, "01/02/2021", "05/02/2021", "0.1", "dated"),
    ], BRIEFING)


def test_latest_submission_wins(briefing):
    rows = {r.campaign_id: r for r in linking.clean_briefing(briefing, tie=["n"]).collect()}
    assert rows["c1"].kpis == "new" and rows["c1"].buy_rate_cpe == 0.0
    assert rows["c1"].startdate == dt.datetime(2021, 2, 3)
    assert rows["c2"].kpis == "dated"


def design(spark):
    return spark.createDataFrame(
        [("k1", "r1", "up", 2.0), ("k2", "r1", "left", 3.0)],
        "md5_game_key string, request_id string, interaction_direction string, aspect_ratio double")


def test_link_keeps_rows_and_fans_out(spark, briefing):
    kpis = kpi.creative_kpis(events(spark), min_impressions=1)
    campaigns = linking.clean_briefing(briefing, tie=["n"]).withColumn("campaign_id", F.lit("spring"))
    campaigns = campaigns.filter("kpis = 'new'")
    linked = linking.link(kpis, design(spark), campaigns)
    # the two spring rows match two design records each, the others none
    assert linked.count() == kpis.count() + 2
    row = linked.filter("campaign_id = 'spring'").first()
    assert row.campaign_duration_days == 0 and row.image_filename == "banner-r1.png"
    assert linked.filter("campaign_id = 'summer' and md5_game_key is not null").isEmpty()


def test_image_columns_do_not_replace_design_columns(spark):
    linked = spark.createDataFrame([("a.png", 2.0)], "image_filename string, aspect_ratio double")
    vision = spark.createDataFrame(
        [("a.png", 9.0, 0.5, 2), ("a.png", 9.0, 0.7, 1)],
        "filename string, aspect_ratio double, brightness_mean double, seq int")
    row = linking.attach_vision(linked, vision, order=["seq"]).first()
    assert (row.aspect_ratio, row.brightness_mean) == (2.0, 0.7)


def test_creatives_take_video_from_design(spark):
    vision = spark.createDataFrame(
        [("banner-r1.png", 1.0, 0.2, 0.1, 0.1, 3.0, 0.5, 1.0, 0.0)],
        "filename string, aspect_ratio double, brightness_mean double, saturation_mean double, colorfulness double, "
        "visual_entropy double, color_diversity_score double, is_dark_background double, is_light_background double")
    videos = spark.createDataFrame([("r1", 1), ("r1", 0)], "request_id string, has_video int")
    rows = {r.game_key: r for r in linking.creatives(events(spark), vision, videos).collect()}
    assert set(rows) == {"banner/r1", "video/r2", "x/y/r3"}
    assert (rows["banner/r1"].has_video, rows["banner/r1"].is_dark_background) == (True, True)
    assert (rows["x/y/r3"].has_video, rows["x/y/r3"].brightness_mean) == (False, 0.0)
    plain = linking.creatives(events(spark), vision).filter("has_video")
    assert plain.isEmpty()
    blind = linking.creatives(events(spark), None)
    assert blind.count() == 3 and blind.filter("brightness_mean <> 0 or is_dark_background").isEmpty()


def test_deduplication_without_an_order_is_repeatable(spark):
    rows = [(f"k{i % 3}", i) for i in range(60)]
    picks = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "k string, v int").repartition(parts)
        picks.add(tuple(sorted(tuple(r) for r in linking.first_per_key(df, ["k"]).collect())))
    assert len(picks) == 1 and len(picks.pop()) == 3


def test_reports_on_joins(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    right = spark.createDataFrame([("a",), ("c",)], "key string")
    assert tuple(linking.key_overlap(left, right, "key").first()) == (2, 2, 1)
    assert [r.key for r in linking.orphans(left, right, "key").collect()] == ["b"]
    images = spark.createDataFrame([("f1", "r1"), ("f2", None)], "filename string, request_id string")
    joined = linking.resolve_images(images, design(spark))
    assert joined.count() == 3
    assert tuple(linking.match_rate(joined, "md5_game_key").first())[:2] == (2, 3)


def test_hot_key_needs_one_row_per_task(spark):
    """Deduplication limits each key before the shuffle, counts are partial before the shuffle."""
    rows = spark.range(1000).selectExpr("if(id % 3 > 0, 1, id) as k", "id")
    plan = linking.first_per_key(rows, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange"):]
    plan = kpi.creative_metrics(events(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1
