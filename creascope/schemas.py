"""Explicit schemas of the domain tables and documents."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOL, TIME = T.DoubleType(), T.BooleanType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)
TEXT_MAP = T.MapType(STRING, STRING)
NUMBER_MAP = T.MapType(STRING, DOUBLE)

INVENTORY = _struct(
    campaign_id=STRING, game_key=STRING, type=STRING, device_type=STRING,
    platform_os=STRING, geo_country=STRING, browser_ts=TIME,
)

BRIEFING = _struct(
    campaign_id=STRING, submission_date=TIME, campaign_name=STRING, campaign_objectives=STRING,
    kpis=STRING, startdate=TIME, enddate=TIME, currency=STRING,
    buy_rate_cpe=DOUBLE, volume_agreed=DOUBLE, gross_cost_budget=DOUBLE,
)

# One request of the design document. Colour zones stay raw JSON text here: a map with one
# mistyped value would come back NULL as a whole, so they are parsed entry by entry later.
_ZONES = _struct(engagement=STRINGS, click_through=STRINGS)
DESIGN_RECORD = _struct(
    labels=_ZONES,
    text=_ZONES,
    colors=_struct(engagement=STRING, click_through=STRING),
    videos_data=_struct(has_video=STRING, videos_length=NUMBER_MAP),
    direction=_struct(direction=STRING),
    adunit_sizes=_struct(size_x=DOUBLE, size_y=DOUBLE),
)
COLOR_ENTRY = _struct(
    red=DOUBLE, green=DOUBLE, blue=DOUBLE, proportion=DOUBLE, saturation=DOUBLE, luminosity=DOUBLE,
)

PALETTE_RECORD = _struct(
    text=_struct(engagement=STRINGS, click_through=NUMBER_MAP),
    colors=_struct(engagement=NUMBER_MAP, click_through=NUMBER_MAP),
    videos_data=_struct(has_video=STRING),
)

BENCHMARK_MODEL = _struct(
    mae_mean=DOUBLE, mae_std=DOUBLE, rmse_mean=DOUBLE, rmse_std=DOUBLE,
    r2_mean=DOUBLE, r2_std=DOUBLE, mape_mean=DOUBLE, mape_std=DOUBLE,
    feature_importance=NUMBER_MAP,
    n_folds=LONG, n_features=LONG, n_train_campaigns=LONG, error=STRING,
)
BENCHMARK_DOC = _struct(
    target=STRING, group_col=STRING, dataset_size=LONG, n_campaigns=LONG, models=TEXT_MAP,
)

MODEL_BENCHMARKS = _struct(
    run_timestamp=TIME, target_metric=STRING, model_name=STRING,
    mae=DOUBLE, rmse=DOUBLE, r2=DOUBLE, mape=DOUBLE, n_features=LONG,
)
FEATURE_IMPORTANCES = _struct(
    run_timestamp=TIME, model_name=STRING, feature_name=STRING,
    importance_score=DOUBLE, category=STRING,
)
