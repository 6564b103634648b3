import json

import pytest

from creascope.operators.design import flatten_design, legacy_design_table, request_keys
from creascope.sources.files import design_items, read_design, write_design_lines

FULL = {
    "labels": {"engagement": ["Harbour", "Boat", "Dusk"], "click_through": []},
    "text": {"engagement": ["Sail", "tonight"], "click_through": ["Tickets", "Map", "Prices"]},
    "colors": {
        "engagement": {
            "1": {"red": 51, "green": 102, "blue": 204, "proportion": 0.7, "saturation": 0.6, "luminosity": 0.4},
            "2": {"red": 250, "green": 240, "blue": 230, "proportion": 0.3, "saturation": 0.2, "luminosity": 0.9}},
        "click_through": {"1": {"red": 9, "green": 9, "blue": 9, "proportion": 1.0}}},
    "videos_data": {"has_video": 0, "videos_length": {}}, "direction": {"direction": "left"},
    "adunit_sizes": {"size_x": 728, "size_y": 91},
}
EMPTY = {"labels": {}, "colors": {"engagement": {}}, "videos_data": {"has_video": 1, "videos_length": {"teaser": 6.5}}}
ODD = {
    "text": {"engagement": {"not": "a list"}, "click_through": ["x"]},
    "colors": {"engagement": {"1": {"red": 51}, "2": {"saturation": 0.4, "luminosity": 0.2}, "3": "bad"}},
    "videos_data": {"has_video": True, "videos_length": {"a": 10, "b": 20}},
    "adunit_sizes": {"size_x": 10, "size_y": 0},
}
DOC = {"key_1": {"req_a": FULL, "skip": 5}, "key_2": {"req_b": EMPTY, "req_a": ODD}, "key_3": "no map"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(json.dumps(DOC),)], "doc string").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return {(r.md5_game_key, r.request_id): r for r in flatten_design(docs).collect()}


def test_one_row_per_request_object(rows):
    assert set(rows) == {("key_1", "req_a"), ("key_2", "req_b"), ("key_2", "req_a")}


def test_expected_columns(docs):
    names = flatten_design(docs).columns
    assert len(names) == 22
    assert {"n_engagement_labels", "has_video", "color_saturation_mean", "aspect_ratio"} <= set(names)


def test_full_record(rows):
    r = rows["key_1", "req_a"]
    assert (r.n_engagement_labels, r.n_click_through_labels, r.n_engagement_texts, r.n_click_through_texts) == (3, 0, 2, 3)
    assert (r.engagement_labels_text, r.engagement_text_content) == ("Harbour Boat Dusk", "Sail tonight")
    assert (r.dominant_color_r, r.dominant_color_g, r.dominant_color_proportion) == (0.2, 0.4, 0.7)
    assert (r.color_saturation_mean, r.color_luminosity_mean) == pytest.approx((0.4, 0.65))
    assert r.color_diversity == 2
    assert r.brightness == pytest.approx((0.2 + 0.4 + 0.8) / 3) and r.aspect_ratio == pytest.approx(8.0)
    assert (r.has_video, r.video_length_seconds, r.interaction_direction) == (0, 0.0, "left")


def test_empty_record(rows):
    r = rows["key_2", "req_b"]
    assert (r.color_diversity, r.color_saturation_mean, r.dominant_color_r) == (0, 0.0, 0.0)
    assert (r.has_video, r.video_length_seconds) == (1, 6.5)
    assert (r.engagement_labels_text, r.adunit_width, r.aspect_ratio) == ("", 0.0, 0.0)


def test_malformed_parts_do_not_spoil_the_rest(rows):
    r = rows["key_2", "req_a"]
    assert (r.n_engagement_labels, r.n_engagement_texts, r.n_click_through_texts) == (0, 0, 1)
    assert r.color_diversity == 3  # the bad entry counts here ...
    assert r.color_saturation_mean == pytest.approx(0.2)  # ... but not in the mean
    assert r.color_luminosity_mean == pytest.approx(0.1)
    assert r.dominant_color_r == pytest.approx(0.2) and r.dominant_color_proportion == 0.0
    assert (r.has_video, r.video_length_seconds) == (1, 15.0)
    assert (r.interaction_direction, r.aspect_ratio) == ("no direction", 0.0)


def test_legacy_layout(docs):
    table = legacy_design_table(docs)
    assert len(table.columns) == 9
    rows = {r.game_key: r for r in table.collect()}
    assert rows["key_1/req_a"].labels_engagement == "Harbour,Boat,Dusk"
    assert set(rows["key_2/req_a"].color_engagement) == {"1", "2", "3"}
    assert {r.game_key for r in request_keys(docs).collect()} == {
        "key_1/req_a", "key_1/skip", "key_2/req_b", "key_2/req_a"}


def test_documents_from_files(spark, rows, tmp_path):
    (tmp_path / "design.json").write_text(json.dumps(DOC, indent=1))
    docs = read_design(spark, str(tmp_path / "design.json"))
    assert design_items(docs).count() == 3
    lines = str(tmp_path / "lines")
    write_design_lines(docs, lines)
    again = flatten_design(read_design(spark, lines, whole=False)).collect()
    assert {(r.md5_game_key, r.request_id): r for r in again} == rows
