"""Column names and column selection: everything here only touches metadata."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The feature columns of the modelling table.
CATEGORICAL_FEATURES = ["device_type", "platform_os", "geo_country", "interaction_direction"]
DESIGN_FEATURES = [
    "has_video", "video_length_seconds",
    "n_engagement_labels", "n_click_through_labels", "n_engagement_texts", "n_click_through_texts",
    "dominant_color_r", "dominant_color_g", "dominant_color_b", "dominant_color_proportion",
    "color_saturation_mean", "color_luminosity_mean", "color_diversity", "brightness", "aspect_ratio",
]
CAMPAIGN_FEATURES = ["buy_rate_cpe", "volume_agreed", "gross_cost_budget", "campaign_duration_days"]
IMAGE_FEATURES = [
    "brightness_mean", "saturation_mean", "colorfulness", "visual_entropy",
    "color_diversity_score", "is_dark_background", "is_light_background", "file_size_kb",
]
PCA_PREFIX = "vision_pca_"


def normalize_name(name: str, style: str = "strict") -> str:
    """``strict`` keeps only ``[a-z0-9_]``; ``simple`` replaces blanks and slashes, drops brackets."""
    lowered = name.lower()
    if style == "simple":
        return lowered.strip().translate(str.maketrans({" ": "_", "/": "_", "(": None, ")": None}))
    return "_".join(re.findall("[a-z0-9]+", lowered))


def normalize_columns(df: DataFrame, style: str = "strict") -> DataFrame:
    return df.toDF(*(normalize_name(name, style) for name in df.columns))


def keep_present(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Project to the listed columns that exist, renaming when a mapping is given."""
    if not isinstance(mapping, Mapping):
        mapping = {name: name for name in mapping}
    return df.select([F.col(old).alias(new) for old, new in mapping.items() if old in df.columns])


def select_tabular_features(df: DataFrame) -> list[str]:
    encoded = [f"{name}_enc" for name in CATEGORICAL_FEATURES]
    wanted = encoded + DESIGN_FEATURES + CAMPAIGN_FEATURES
    return [name for name in wanted if name in df.columns]


def select_vision_features(df: DataFrame, use_pca: bool = True) -> list[str]:
    chosen = [name for name in IMAGE_FEATURES if name in df.columns]
    if use_pca:
        # by component number, so that 10 follows 9
        components = [name for name in df.columns if re.fullmatch(PCA_PREFIX + r"\d+", name)]
        chosen += sorted(components, key=lambda name: int(name[len(PCA_PREFIX):]))
    return chosen


def feature_sets(df: DataFrame) -> dict[str, list[str]]:
    tabular, vision = select_tabular_features(df), select_vision_features(df)
    return {
        "tabular": tabular,
        "vision": vision,
        "multimodal": tabular + [name for name in vision if name not in tabular],
    }


def filled_number(name: str, fill: float = 0.0) -> Column:
    """A column as double; text that is no number, NaN and NULL become ``fill``."""
    return F.expr(f"coalesce(nullif(try_cast(`{name}` as double), double('NaN')), {float(fill)!r}D)")


def align_columns(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``expected`` as doubles, in that order; absent columns, NaN and NULL become 0.0."""
    aligned = [
        (filled_number(name) if name in df.columns else F.lit(0.0)).alias(name) for name in expected
    ]
    return df.select(*keep, *aligned)
