"""Linking events, creatives, campaigns, design and images.

Joins carry no broadcast hints: the planner and adaptive execution choose from measured
sizes, so a dimension that outgrows the broadcast threshold falls back to a shuffled join,
where skewed partitions of the preserved side are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from creascope.functions.cleaning import (
    DAY_FIRST_FORMATS, duration_days, flag, image_filename, number_or_zero, parse_time,
    split_game_key,
)
from creascope.functions.columns import keep_present

# Briefing columns that enter the linked table, and the ones cleaned.
BRIEFING_COLUMNS = [
    "campaign_id", "campaign_name", "campaign_objectives", "kpis", "startdate", "enddate",
    "currency", "buy_rate_cpe", "volume_agreed", "gross_cost_budget",
]
BRIEFING_DATES = ["submission_date", "startdate", "enddate"]
BRIEFING_NUMBERS = ["buy_rate_cpe", "volume_agreed", "gross_cost_budget"]
# Image measures stored with a creative.
CREATIVE_MEASURES = [
    "aspect_ratio", "brightness_mean", "saturation_mean", "colorfulness",
    "visual_entropy", "color_diversity_score",
]
CREATIVE_FLAGS = ["is_dark_background", "is_light_background"]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key by a declared order; what it leaves equal is decided by a row hash.

    Filtering on rank 1 lets Spark keep only the best row of each key per task before the
    shuffle, so a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*df.columns))
    rank = F.row_number().over(window)
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def clean_briefing(
    briefing: DataFrame,
    tie: Sequence[str] = (),
    formats: Sequence[str] = DAY_FIRST_FORMATS,
) -> DataFrame:
    """Latest submission per campaign, dates day-first, bad numbers 0.

    Equal submission dates are decided by the ``tie`` columns, highest first, then by a row
    hash. The submission date is parsed before it is compared; unreadable dates sort last.
    """
    present = set(briefing.columns)
    types = dict(briefing.dtypes)
    parsed = {
        name: parse_time(F.col(name), formats)
        for name in BRIEFING_DATES if name in present and types[name] == "string"
    }
    numbers = {name: number_or_zero(F.col(name)) for name in BRIEFING_NUMBERS if name in present}
    order = [F.desc_nulls_last(name) for name in ("submission_date", *tie) if name in present]
    if "submission_date" in parsed:
        briefing = briefing.withColumn("submission_date", parsed.pop("submission_date"))
    latest = first_per_key(briefing, ["campaign_id"], order)
    return latest.withColumns({**parsed, **numbers})


def campaigns(briefing: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Campaign dimension: one cleaned briefing row per known campaign."""
    columns = [name for name in BRIEFING_COLUMNS if name != "kpis"]
    known = briefing.filter(F.col("campaign_id").isNotNull())
    return keep_present(clean_briefing(known, tie), columns)


def creative_keys(events: DataFrame) -> DataFrame:
    """Distinct game keys that name a creative, with their parts and image file.

    ``events`` is the event log or its counts.
    """
    keys = events.filter(F.contains("game_key", F.lit("/"))).select("game_key").distinct()
    slug, request_id = split_game_key(F.col("game_key"))
    parts = keys.withColumns({"creative_slug": slug, "creative_request_id": request_id})
    return parts.withColumn(
        "image_filename", image_filename(F.col("creative_slug"), F.col("creative_request_id")))


def creatives(
    events: DataFrame,
    vision: DataFrame | None,
    design: DataFrame | None = None,
    vision_order: Sequence[str] = (),
) -> DataFrame:
    """Creative dimension: every key with a slash, image measures where an image is known.

    ``events`` is the event log or its counts.
    """
    joined = creative_keys(events)
    if vision is not None:
        # columns first: only these are scanned and compared
        needed = dict.fromkeys(["filename", *vision_order, *CREATIVE_MEASURES, *CREATIVE_FLAGS])
        images = first_per_key(
            vision.select(*needed), ["filename"], [F.asc(name) for name in vision_order]).select(
            F.col("filename").alias("image_filename"), *CREATIVE_MEASURES, *CREATIVE_FLAGS)
        joined = joined.join(images, "image_filename", "left")
    else:
        joined = joined.withColumns(
            {name: F.lit(None).cast("double") for name in (*CREATIVE_MEASURES, *CREATIVE_FLAGS)})
    if design is not None:
        videos = design.groupBy(F.col("request_id").alias("creative_request_id")).agg(
            F.max("has_video").alias("has_video"))
        joined = joined.join(videos, "creative_request_id", "left")
    else:
        joined = joined.withColumn("has_video", F.lit(None).cast("int"))
    return joined.select(
        "game_key", "creative_slug", "creative_request_id", "image_filename",
        *[F.coalesce(name, F.lit(0.0)).alias(name) for name in CREATIVE_MEASURES],
        *[flag(F.col(name)).alias(name) for name in ("has_video", *CREATIVE_FLAGS)],
    )


def resolve_images(images: DataFrame, design: DataFrame) -> DataFrame:
    """Images with the design record of the same request id, if any."""
    return images.join(design, "request_id", "left")


def link(kpi: DataFrame, design: DataFrame, briefing: DataFrame) -> DataFrame:
    """KPI rows with design and campaign context.

    A request id under several outer keys gives one row per design record.
    """
    records = design.withColumnRenamed("request_id", "creative_request_id")
    context = keep_present(briefing, BRIEFING_COLUMNS)
    linked = kpi.join(records, "creative_request_id", "left").join(context, "campaign_id", "left")
    if {"startdate", "enddate"} <= set(context.columns):
        linked = linked.withColumn(
            "campaign_duration_days", duration_days(F.col("startdate"), F.col("enddate")))
    return linked.withColumn(
        "image_filename", image_filename(F.col("creative_slug"), F.col("creative_request_id")))


def linked_from_tables(
    metrics: DataFrame, creative_dim: DataFrame, campaign_dim: DataFrame, design: DataFrame
) -> DataFrame:
    """The same linked table read from the warehouse tables."""
    identity = creative_dim.select("game_key", "creative_slug", "creative_request_id", "image_filename")
    records = design.drop("md5_game_key").withColumnRenamed("request_id", "creative_request_id")
    return (
        metrics.filter(F.col("campaign_id").isNotNull())
        .join(identity, "game_key", "left")
        .join(campaign_dim, "campaign_id", "left")
        .withColumn("campaign_duration_days", duration_days(F.col("startdate"), F.col("enddate")))
        .join(records, "creative_request_id", "left")
    )


def attach_vision(
    linked: DataFrame, vision: DataFrame, order: Sequence[str] = ()
) -> DataFrame:
    """Add the vision columns the linked table does not have, first row per file."""
    identity = {"filename", "filepath", "slug", "request_id"}
    added = [name for name in vision.columns if name not in identity and name not in linked.columns]
    # only what is added or ranks a row: other columns need not be read
    used = list(dict.fromkeys(["filename", *added, *order]))
    images = first_per_key(vision.select(*used), ["filename"], [F.asc(name) for name in order])
    images = images.select(F.col("filename").alias("image_filename"), *added)
    return linked.join(images, "image_filename", "left")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key has no parent."""
    referenced = child.filter(F.col(key).isNotNull())
    return referenced.join(parent.select(key), key, "left_anti")


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side and in both, with one shuffle over both sides."""
    def side(df: DataFrame, in_left: int, in_right: int) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).cast("string").alias("key"),
            F.lit(in_left).alias("in_left"), F.lit(in_right).alias("in_right"))

    sides = side(left, 1, 0).unionByName(side(right, 0, 1))
    per_key = sides.groupBy("key").agg(F.max("in_left").alias("l"), F.max("in_right").alias("r"))
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
    )


def match_rate(joined: DataFrame, column: str) -> DataFrame:
    """Matched rows, all rows and their ratio after a left join; ``column`` is from the right side."""
    counted = joined.agg(F.count(column).alias("n_matched"), F.count("*").alias("n_rows"))
    return counted.withColumn("match_rate", F.try_divide("n_matched", "n_rows"))
