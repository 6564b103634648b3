"""Nested design documents -> one row per (md5_game_key, request_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creascope import schemas

# Dominant palette entry, channel range, missing direction.
DOMINANT_KEY = "1"
CHANNEL_RANGE = 255
NO_DIRECTION = "no direction"

def _explode_object(df: DataFrame, text: str, key: str, value: str, *keep: str) -> DataFrame:
    """One row per entry of a JSON object held as text; anything but an object gives no row."""
    entries = F.from_json(F.col(text), schemas.TEXT_MAP)
    return df.select(*keep, F.explode(entries).alias(key, value))


def design_records(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Parsed record per outer key and request.

    The levels are parsed one at a time: in a single nested map schema one malformed entry
    would turn its whole document into NULL.
    """
    outer = _explode_object(docs, doc, "md5_game_key", "_requests")
    inner = _explode_object(outer, "_requests", "request_id", "_record", "md5_game_key")
    objects = inner.filter(F.startswith(F.ltrim("_record"), F.lit("{")))
    return objects.select(
        "md5_game_key", "request_id",
        F.from_json("_record", schemas.DESIGN_RECORD).alias("record"),
    )


def count_of(items: Column) -> Column:
    return F.when(items.isNotNull(), F.size(items)).otherwise(0)


def joined(items: Column, separator: str) -> Column:
    return F.coalesce(F.array_join(items, separator), F.lit(""))


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0))


def mean_of(numbers: Column) -> Column:
    """Mean of an array with missing items counted as 0; 0 for an empty array."""
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + or_zero(x))
    return F.when(count_of(numbers) > 0, total / F.size(numbers)).otherwise(0.0)


def color_entry(text: Column) -> Column:
    """One palette entry as a struct; NULL if it is not an object."""
    return F.when(F.startswith(F.ltrim(text), F.lit("{")), F.from_json(text, schemas.COLOR_ENTRY))


def _video_flag(text: Column) -> Column:
    as_number = text.try_cast("double").cast("int")
    return F.coalesce(as_number, F.when(F.lower(text) == "true", 1), F.lit(0))


def flatten_design(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Two keys and 20 design features per request."""
    records = design_records(docs, doc)
    parsed = records.select(
        "md5_game_key", "request_id", "record",
        F.from_json("record.colors.engagement", schemas.TEXT_MAP).alias("palette"),
        _video_flag(F.col("record.videos_data.has_video")).alias("has_video"),
    ).withColumns({
        "dominant": color_entry(F.try_element_at("palette", F.lit(DOMINANT_KEY))),
        "entries": F.filter(F.transform(F.map_values("palette"), color_entry), lambda c: c.isNotNull()),
    })

    def channel(name: str) -> Column:
        return or_zero(F.col(f"dominant.{name}") / CHANNEL_RANGE)

    red, green, blue = channel("red"), channel("green"), channel("blue")
    width = or_zero(F.col("record.adunit_sizes.size_x"))
    height = or_zero(F.col("record.adunit_sizes.size_y"))
    labels, texts = "record.labels", "record.text"
    lengths = F.map_values(F.col("record.videos_data.videos_length"))
    return parsed.select(
        "md5_game_key",
        "request_id",
        count_of(F.col(f"{labels}.engagement")).alias("n_engagement_labels"),
        count_of(F.col(f"{labels}.click_through")).alias("n_click_through_labels"),
        joined(F.col(f"{labels}.engagement"), " ").alias("engagement_labels_text"),
        count_of(F.col(f"{texts}.engagement")).alias("n_engagement_texts"),
        count_of(F.col(f"{texts}.click_through")).alias("n_click_through_texts"),
        joined(F.col(f"{texts}.engagement"), " ").alias("engagement_text_content"),
        red.alias("dominant_color_r"),
        green.alias("dominant_color_g"),
        blue.alias("dominant_color_b"),
        or_zero(F.col("dominant.proportion")).alias("dominant_color_proportion"),
        mean_of(F.col("entries.saturation")).alias("color_saturation_mean"),
        mean_of(F.col("entries.luminosity")).alias("color_luminosity_mean"),
        count_of(F.col("palette")).alias("color_diversity"),
        ((red + green + blue) / 3).alias("brightness"),
        "has_video",
        F.when(F.col("has_video") != 0, mean_of(lengths)).otherwise(0.0).alias("video_length_seconds"),
        F.coalesce("record.direction.direction", F.lit(NO_DIRECTION)).alias("interaction_direction"),
        width.alias("adunit_width"),
        height.alias("adunit_height"),
        F.when(height > 0, width / height).otherwise(0.0).alias("aspect_ratio"),
    )


def legacy_design_table(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """The older nine-column layout: comma-joined texts and the raw colour maps."""
    record = "record"
    return design_records(docs, doc).select(
        F.concat_ws("/", "md5_game_key", "request_id").alias("game_key"),
        joined(F.col(f"{record}.labels.engagement"), ",").alias("labels_engagement"),
        joined(F.col(f"{record}.labels.click_through"), ",").alias("labels_click_through"),
        joined(F.col(f"{record}.text.engagement"), ",").alias("text_engagement"),
        joined(F.col(f"{record}.text.click_through"), ",").alias("text_click_through"),
        F.from_json(f"{record}.colors.engagement", schemas.TEXT_MAP).alias("color_engagement"),
        F.from_json(f"{record}.colors.click_through", schemas.TEXT_MAP).alias("color_click_through"),
        _video_flag(F.col(f"{record}.videos_data.has_video")).alias("video_data"),
        F.col(f"{record}.direction.direction").alias("direction"),
    )


def request_keys(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Composite ``outer/request`` keys of every request, whatever its value."""
    outer = _explode_object(docs, doc, "md5_game_key", "_requests")
    inner = _explode_object(outer, "_requests", "request_id", "_record", "md5_game_key")
    return inner.select(F.concat_ws("/", "md5_game_key", "request_id").alias("game_key"))
