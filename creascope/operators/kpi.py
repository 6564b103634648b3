"""Engagement and click-through rates per creative, context and campaign.

All counts are conditional counts in one ``groupBy``: every task reduces its rows to one
partial count per key before the shuffle, so a key that holds a third of the events sends
one row per task, not a third of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from creascope.functions.cleaning import rate, split_game_key

# Event type -> count column.
EVENT_COUNTS = {
    "impression": "n_impressions",
    "first_dropped": "n_engagements",
    "click-through-event": "n_clicks",
}
# Grouping columns of one KPI row.
CONTEXT = ["device_type", "platform_os", "geo_country"]
KEYS = ["campaign_id", "game_key", *CONTEXT]


def event_counts() -> list[Column]:
    return [F.count_if(F.col("type") == kind).alias(name) for kind, name in EVENT_COUNTS.items()]


def _rates(clipped: bool) -> dict[str, Column]:
    shown = F.col("n_impressions")
    return {
        "engagement_rate": rate(F.col("n_engagements"), shown, clipped),
        "click_through_rate": rate(F.col("n_clicks"), shown, clipped),
    }


def creative_kpis(
    inventory: DataFrame,
    min_impressions: int = 10,
    drop_null_keys: bool = True,
    clipped: bool = True,
    keep_types: Sequence[str] | str = (),
) -> DataFrame:
    """Counts and rates per campaign, creative and context with enough impressions.

    ``keep_types`` keeps the counts of other event types: a list of names adds a column for each,
    ``"map"`` a column ``type_counts`` with every type found. ``"all"`` pivots every type found into a
    column, which scans the log once more for the types and is limited to as many as the session allows.
    """
    keys = [name for name in KEYS if name in inventory.columns]
    events = inventory.filter(F.col("type").isNotNull())
    if drop_null_keys:
        for name in keys:
            events = events.filter(F.col(name).isNotNull())
        # the request id is part of the key, and a key without a slash has none
        events = events.filter(F.contains("game_key", F.lit("/")))
    grouped = events.groupBy(*keys)
    if keep_types == "all":
        counted = grouped.pivot("type").count().na.fill(0)
        counted = counted.withColumnsRenamed(EVENT_COUNTS)
        absent = [name for name in EVENT_COUNTS.values() if name not in counted.columns]
        counted = counted.withColumns({name: F.lit(0).cast("long") for name in absent})
    elif keep_types == "map":
        # reduced by key and type first, so a key's map is put together from one row per type
        per_type = events.groupBy(*keys, "type").agg(F.count("*").alias("n"))
        counted = per_type.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("type_counts"))
        counted = counted.withColumns({
            name: F.coalesce(F.col("type_counts")[kind], F.lit(0)) for kind, name in EVENT_COUNTS.items()})
    else:
        extra = [F.count_if(F.col("type") == kind).alias(kind) for kind in keep_types]
        counted = grouped.agg(*event_counts(), *extra)
    slug, request_id = split_game_key(F.col("game_key"))
    kept = counted.filter(F.col("n_impressions") >= min_impressions)
    return kept.withColumns(
        {"creative_slug": slug, "creative_request_id": request_id, **_rates(clipped)}
    )


def context_counts(inventory: DataFrame) -> DataFrame:
    """Event counts per campaign, creative and context, NULL keys kept.

    The one reduction of the event log that the warehouse needs: metrics, creatives and
    campaign totals all follow from this much smaller table.
    """
    return inventory.groupBy(*KEYS).agg(*event_counts())


def metrics_from_counts(counts: DataFrame, creatives: DataFrame | None = None) -> DataFrame:
    """Warehouse metrics: known campaign and creative, no minimum, unclipped rates."""
    metrics = counts.filter(F.col("campaign_id").isNotNull() & F.contains("game_key", F.lit("/")))
    if creatives is not None:
        metrics = metrics.join(creatives.select("game_key"), "game_key", "left_semi")
    return metrics.select(*KEYS, *EVENT_COUNTS.values()).withColumns(_rates(clipped=False))


def creative_metrics(inventory: DataFrame, creatives: DataFrame | None = None) -> DataFrame:
    """Warehouse metrics from events; NULL contexts are kept.

    Keys unknown to ``creatives`` are left out. That check runs on the aggregated rows: a
    group has one game key, so the result is the same and the event log is shuffled once.
    """
    return metrics_from_counts(context_counts(inventory), creatives)


def campaign_kpis(inventory: DataFrame) -> DataFrame:
    """Percent rates per campaign; a missing event type counts 0, no impressions gives NULL."""
    counted = (
        inventory.filter(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id").agg(*event_counts())
    )
    rates = _rates(clipped=False)
    return counted.select(
        "campaign_id",
        (rates["engagement_rate"] * 100).alias("ER"),
        (rates["click_through_rate"] * 100).alias("CTR"),
    )


def kpi_profile(df: DataFrame) -> DataFrame:
    """One row of sizes, distinct keys, means and sample deviations."""
    distinct = {
        "n_campaigns": "campaign_id", "n_game_keys": "game_key", "n_slugs": "creative_slug",
    }
    measures = {"er": "engagement_rate", "ctr": "click_through_rate"}
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        *[F.count_distinct(c).alias(a) for a, c in distinct.items() if c in df.columns],
        *[F.avg(c).alias(f"{a}_mean") for a, c in measures.items()],
        *[F.stddev_samp(c).alias(f"{a}_std") for a, c in measures.items()],
    )


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; equal counts in order of the value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)
