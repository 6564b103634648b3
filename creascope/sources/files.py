"""Readers of the raw files. Text columns stay text: types are set by the cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creascope import schemas
from creascope.functions.cleaning import (
    EVENT_TIME_FORMATS, clean_label, feature_category, missing_to_null, parse_time, placement_type, size_kb,
    split_asset_name,
)
from creascope.functions.columns import normalize_columns
from creascope.operators.design import design_records


def read_csv(spark: SparkSession, path, names: str = "strict", multiline: bool = False) -> DataFrame:
    """CSV with a header: normalised names, all columns text, missing markers as NULL.

    Only the header is read up front. Files stay splittable, which asks for one record per line;
    ``multiline`` allows line breaks inside quotes and reads each file in one task.
    """
    raw = spark.read.options(header=True, escape='"', multiLine=multiline).csv(path)
    raw = normalize_columns(raw, names)
    return raw.select([missing_to_null(F.col(name)).alias(name) for name in raw.columns])


def read_briefing(spark: SparkSession, path) -> DataFrame:
    """Raw briefing rows, free text with line breaks included; see ``clean_briefing``."""
    return read_csv(spark, path, multiline=True)


def clean_inventory(df: DataFrame) -> DataFrame:
    """Event log with trimmed lower-case types and a parsed browser time."""
    if "type" in df.columns:
        df = df.withColumn("type", clean_label(F.col("type")))
    if dict(df.dtypes).get("browser_ts") == "string":
        df = df.withColumn("browser_ts", parse_time(F.col("browser_ts"), EVENT_TIME_FORMATS))
    return df


def read_inventory(spark: SparkSession, path) -> DataFrame:
    """Cleaned event log of one file, a folder or a list of paths."""
    return clean_inventory(read_csv(spark, path))


def concat(*parts: DataFrame) -> DataFrame:
    """Rows of several parts of one table; columns a part lacks are NULL."""
    result, *rest = parts
    for part in rest:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def read_design(spark: SparkSession, path, whole: bool = True) -> DataFrame:
    """Design documents as text in column ``doc``.

    ``whole=True`` takes each file as one document, which a single task has to parse.
    ``whole=False`` takes one document per line, the layout ``write_design_lines`` produces
    and the one to use for large data: it is splittable.
    """
    return spark.read.text(path, wholetext=whole).withColumnRenamed("value", "doc")


def design_items(docs: DataFrame) -> DataFrame:
    """Top-level entries of the design documents as (md5_game_key, requests)."""
    return docs.select(
        F.explode(F.from_json("doc", schemas.TEXT_MAP)).alias("md5_game_key", "requests"))


def write_design_lines(docs: DataFrame, path: str) -> None:
    """Rewrite large documents once as one small document per request."""
    records = design_records(docs)
    entry = F.create_map("md5_game_key", F.create_map("request_id", "record"))
    records.select(F.to_json(entry).alias("value")).write.mode("overwrite").text(path)


def read_palette(spark: SparkSession, path) -> DataFrame:
    """Palette document -> (slug, request_id, zone, r, g, b, proportion), one row per colour."""
    docs = spark.read.text(path, wholetext=True)
    paths = docs.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("item"))
    requests = paths.select(F.explode("item").alias("path", "_requests"))
    records = requests.select(
        F.regexp_extract("path", r"([^/\\]*)$", 1).alias("slug"),
        F.explode(F.from_json("_requests", schemas.TEXT_MAP)).alias("request_id", "_record"))
    parsed = records.filter(F.startswith(F.ltrim("_record"), F.lit("{"))).select(
        "slug", "request_id", F.from_json("_record", schemas.PALETTE_RECORD).alias("rec"))
    zones = F.create_map(
        F.lit("engagement"), F.col("rec.colors.engagement"),
        F.lit("click_through"), F.col("rec.colors.click_through"))
    by_zone = parsed.select("slug", "request_id", F.explode(zones).alias("zone", "palette"))
    colors = by_zone.select("slug", "request_id", "zone", F.explode("palette").alias("_rgb", "proportion"))
    pattern = r"\((\d+),\s*(\d+),\s*(\d+)\)"
    return colors.select(
        "slug", "request_id", "zone",
        *[F.regexp_extract("_rgb", pattern, i).try_cast("int").alias(c) for i, c in enumerate("rgb", 1)],
        "proportion")


def describe_assets(files: DataFrame) -> DataFrame:
    """Registry columns from (filepath, length): name parts, placement and size."""
    named = files.withColumn("filename", F.substring_index("filepath", "/", -1))
    slug, request_id = split_asset_name(F.col("filename"))
    parts = named.withColumns({"slug": slug, "request_id": request_id})
    return parts.select(
        "filename", "filepath", "slug", "request_id",
        placement_type(F.col("slug")).alias("placement_type"),
        size_kb(F.col("length")).alias("file_size_kb"))


def scan_assets(spark: SparkSession, folder: str, glob: str = "*.png") -> DataFrame:
    """Registry of image files. Only names and lengths are read, not the contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return describe_assets(files.select(F.col("path").alias("filepath"), "length"))


def read_images(spark: SparkSession, folder: str, glob: str = "*.png") -> DataFrame:
    """Decoded images; unreadable files are kept with a width of -1."""
    return spark.read.format("image").option("pathGlobFilter", glob).load(folder)


def read_benchmark(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Benchmark documents -> (metrics per model, importance per model and feature).

    Models that carry an ``error`` are left out and missing metrics are 0.
    """
    docs = spark.read.text(path, wholetext=True)
    doc = docs.select(F.from_json("value", schemas.BENCHMARK_DOC).alias("doc"))
    models = doc.select(
        F.coalesce("doc.target", F.lit("engagement_rate")).alias("target_metric"),
        F.explode("doc.models").alias("model_name", "_model"),
    ).filter(F.from_json("_model", schemas.TEXT_MAP).isNotNull()).select(
        "target_metric", "model_name", F.from_json("_model", schemas.BENCHMARK_MODEL).alias("m"),
        F.map_contains_key(F.from_json("_model", schemas.TEXT_MAP), "error").alias("failed"),
    ).filter(~F.col("failed"))
    metrics = models.select(
        "target_metric", "model_name",
        *[F.coalesce(f"m.{name}_mean", F.lit(0.0)).alias(name) for name in ("mae", "rmse", "r2", "mape")],
        F.coalesce("m.n_features", F.lit(0)).alias("n_features"))
    importances = models.select(
        "model_name", F.explode("m.feature_importance").alias("feature_name", "importance_score"))
    return metrics, importances.withColumn("category", feature_category(F.col("feature_name")))


def with_position(df: DataFrame) -> DataFrame:
    """Add ``position``, the place of every row of a Parquet table: file path, then row in the file."""
    return df.withColumn("position", F.struct("_metadata.file_path", "_metadata.row_index"))


def preview(df: DataFrame, n: int = 1000, order: str | None = None) -> DataFrame:
    """A bounded look: any ``n`` rows, or the first ones by ``order``, of which each task keeps ``n``."""
    return df.limit(n) if order is None else df.orderBy(order).limit(n)
