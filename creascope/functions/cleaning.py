"""Scalar cleaning rules, all ``Column -> Column`` and NULL-safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The text that the usual CSV readers take for a missing value.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Accepted date layouts, day first; brackets mark optional parts.
DAY_FIRST_FORMATS = (
    "d/M/yyyy[ H:mm[:ss]]", "d-M-yyyy[ H:mm[:ss]]", "d.M.yyyy[ H:mm[:ss]]",
    "yyyy-M-d[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]",
)
# Further layouts of event times, month first.
EVENT_TIME_FORMATS = ("M/d/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]")
# Placement marker in the slug -> placement type, in order of precedence.
PLACEMENTS = {"-mob": "mobile", "-mpu": "mpu", "-tap": "tap", "-bio": "bio"}
# Name prefixes of visual features.
VISUAL_PREFIXES = (
    "vision_", "color_", "dominant_", "brightness", "saturation", "aspect_", "visual_", "is_",
)
# Fixed value: characters of a request id in a file name.
REQUEST_ID_LENGTH = 20
_BLANKS = " \t\r\n\f\x0b"


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(MISSING_TEXT), value)


def clean_label(value: Column) -> Column:
    """Trimmed, lower-case text of an event type."""
    return F.lower(F.btrim(value, F.lit(_BLANKS)))


def parse_time(value: Column, formats: Sequence[str] = ()) -> Column:
    """Spark's own ISO reading, then the first layout that fits; anything else is NULL."""
    attempts = [F.try_to_timestamp(value, F.lit(layout)) for layout in formats]
    return F.coalesce(F.try_to_timestamp(value), *attempts)


def number_or_null(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def number_or_zero(value: Column) -> Column:
    return F.coalesce(number_or_null(value), F.lit(0.0))


def split_game_key(game_key: Column) -> tuple[Column, Column]:
    """(slug, request id) around the last slash; without a slash (key, NULL)."""
    tail = F.substring_index(game_key, "/", -1)
    head = F.left(game_key, F.length(game_key) - F.length(tail) - 1)
    has_slash = F.contains(game_key, F.lit("/"))
    return F.when(has_slash, head).otherwise(game_key), F.when(has_slash, tail)


def image_filename(slug: Column, request_id: Column) -> Column:
    return F.concat(F.coalesce(slug, F.lit("")), F.lit("-"), F.coalesce(request_id, F.lit("")), F.lit(".png"))


def split_asset_name(filename: Column) -> tuple[Column, Column]:
    """(slug, request id) of an image file; the id must be the 20 characters after the last dash."""
    stem = F.regexp_replace(filename, r"\.png$", "")
    tail = F.substring_index(stem, "-", -1)
    has_id = F.contains(stem, F.lit("-")) & (F.length(tail) == REQUEST_ID_LENGTH)
    head = F.left(stem, F.length(stem) - F.length(tail) - 1)
    return F.when(has_id, head).otherwise(stem), F.when(has_id, tail)


def placement_type(slug: Column) -> Column:
    chain = F
    for marker, placement in PLACEMENTS.items():
        chain = chain.when(F.contains(slug, F.lit(marker)), placement)
    return chain.otherwise("unknown")


def size_kb(n_bytes: Column) -> Column:
    return F.coalesce(F.round(n_bytes / 1024, 2), F.lit(0.0))


def duration_days(start: Column, end: Column) -> Column:
    """Whole days of 24 hours, never negative; NULL if a date is missing."""
    days = F.timestamp_diff("DAY", start, end)
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0))).cast("int")


def clip(value: Column, low: float, high: float) -> Column:
    """Bounded value; NULL stays NULL (``greatest`` and ``least`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def rate(part: Column, whole: Column, clipped: bool) -> Column:
    """``part / whole``, NULL when ``whole`` is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return clip(ratio, 0.0, 1.0) if clipped else ratio


def flag(value: Column) -> Column:
    """0/1 number -> boolean, missing -> false."""
    return F.coalesce(value != 0, F.lit(False))


def category_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("unknown"))


def feature_category(name: Column) -> Column:
    visual = F.lit(False)
    for prefix in VISUAL_PREFIXES:
        visual = visual | F.startswith(name, F.lit(prefix))
    return F.when(visual, "Visual").otherwise("Contextual")


def display_name(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
