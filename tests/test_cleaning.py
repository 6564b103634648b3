import datetime as dt

import pytest
from pyspark.sql import functions as F

from creascope.functions import cleaning as c
from creascope.functions import columns as cols


def test_names():
    raw = ["Campaign Objectives", "Buy Rate (CPE)", "Gross Cost/Budget", " StartDate "]
    strict = [cols.normalize_name(n) for n in raw]
    assert strict == ["campaign_objectives", "buy_rate_cpe", "gross_cost_budget", "startdate"]
    assert [cols.normalize_name(n, "simple") for n in raw] == strict
    assert cols.normalize_name("a--b") == "a_b" and cols.normalize_name("a--b", "simple") == "a--b"


def test_keep_present(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cols.keep_present(df, {"b": "x", "zz": "y"}).columns == ["x"]
    assert cols.keep_present(df, ["a", "zz"]).columns == ["a"]


@pytest.mark.parametrize("key, slug, rid", [
    ("s/r", "s", "r"), ("a/b/c", "a/b", "c"), ("plain", "plain", None), ("s/", "s", ""),
    ("/r", "", "r"), (None, None, None),
])
def test_game_key(one, key, slug, rid):
    column = F.lit(key).cast("string")
    assert one(*c.split_game_key(column)) == [slug, rid]


def test_image_filename_treats_null_as_empty(one):
    null = F.lit(None).cast("string")
    assert one(c.image_filename(F.lit("s"), F.lit("r")), c.image_filename(F.lit("s"), null)) == ["s-r.png", "s-.png"]


@pytest.mark.parametrize("name, slug, rid", [
    ("adunit-x-mob-d071433c0e09216d8f80.png", "adunit-x-mob", "d071433c0e09216d8f80"),
    ("adunit-x-mob-short.png", "adunit-x-mob-short", None),
    ("nodash.png", "nodash", None),
])
def test_asset_name(one, name, slug, rid):
    assert one(*c.split_asset_name(F.lit(name))) == [slug, rid]


@pytest.mark.parametrize("slug, placement", [
    ("a-mob", "mobile"), ("a-mpu-mob-x", "mobile"), ("a-mpu", "mpu"), ("a-tap", "tap"),
    ("a-bio", "bio"), ("a", "unknown"), (None, "unknown"),
])
def test_placement(one, slug, placement):
    assert one(c.placement_type(F.lit(slug).cast("string"))) == [placement]


def test_numbers(one):
    bad, good, null, nan = F.lit("tbc"), F.lit("2.5"), F.lit(None).cast("string"), F.lit("NaN")
    assert one(*[c.number_or_zero(x) for x in (bad, good, null, nan)]) == [0.0, 2.5, 0.0, 0.0]
    assert one(c.size_kb(F.lit(1536)), c.size_kb(F.lit(None).cast("long"))) == [1.5, 0.0]


def test_dates_are_day_first(one):
    read = one(*[c.parse_time(F.lit(x), c.DAY_FIRST_FORMATS) for x in ("04/05/2021", "2021-05-04", "13-2-2021", "soon")])
    assert read == [dt.datetime(2021, 5, 4), dt.datetime(2021, 5, 4), dt.datetime(2021, 2, 13), None]
    event = one(*[c.parse_time(F.lit(x), c.EVENT_TIME_FORMATS) for x in ("4/5/2021 6:07", "2021-05-04T01:02:03")])
    assert event == [dt.datetime(2021, 4, 5, 6, 7), dt.datetime(2021, 5, 4, 1, 2, 3)]


def test_duration(one):
    t = {n: F.lit(x).cast("timestamp") for n, x in {
        "start": "2021-05-01 00:00:00", "later": "2021-05-04 12:00:00"}.items()}
    null = F.lit(None).cast("timestamp")
    assert one(c.duration_days(t["start"], t["later"]), c.duration_days(t["later"], t["start"]),
               c.duration_days(t["start"], null)) == [3, 0, None]


def test_rates_are_null_safe(one):
    zero, five, ten, null = F.lit(0), F.lit(5), F.lit(10), F.lit(None).cast("double")
    assert one(c.rate(five, ten, True), c.rate(ten, five, True), c.rate(ten, five, False),
               c.rate(five, zero, True), c.clip(null, 0.0, 1.0)) == [0.5, 1.0, 2.0, None, None]


def test_labels_and_flags(one):
    assert one(c.clean_label(F.lit(" \tFirst_Dropped\n")), c.flag(F.lit(1.0)), c.flag(F.lit(0.0)),
               c.flag(F.lit(None).cast("double")), c.category_text(F.lit(None).cast("int")),
               c.missing_to_null(F.lit("N/A"))) == ["first_dropped", True, False, False, "unknown", None]


def test_feature_names(one):
    names = ["vision_pca_3", "brightness_mean", "is_dark_background", "buy_rate_cpe", "has_video"]
    assert one(*[c.feature_category(F.lit(n)) for n in names]) == ["Visual"] * 3 + ["Contextual"] * 2
    assert one(c.display_name(F.lit("buy_rate_cpe"))) == ["Buy Rate Cpe"]


def test_feature_selection_and_alignment(spark):
    df = spark.createDataFrame(
        [(1, None, 2.0, 3.0, 4.0, 5.0)],
        "device_type_enc int, has_video double, vision_pca_10 double, vision_pca_9 double, "
        "brightness_mean double, buy_rate_cpe double")
    sets = cols.feature_sets(df)
    assert sets["tabular"] == ["device_type_enc", "has_video", "buy_rate_cpe"]
    assert sets["vision"] == ["brightness_mean", "vision_pca_9", "vision_pca_10"]
    assert sets["multimodal"] == sets["tabular"] + sets["vision"]
    assert cols.select_vision_features(df, use_pca=False) == ["brightness_mean"]
    aligned = cols.align_columns(df, ["absent", "has_video", "buy_rate_cpe"])
    assert aligned.columns == ["absent", "has_video", "buy_rate_cpe"]
    assert list(aligned.first()) == [0.0, 0.0, 5.0]
    odd = spark.sql("select double('NaN') as a, 'x' as b, '2' as c, true as d")
    assert list(cols.align_columns(odd, ["a", "b", "c", "d"]).first()) == [0.0, 0.0, 2.0, 1.0]
