"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is run to
completion (all columns of all rows) after one short warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from creascope.plans.binding import Domain  # noqa: E402
from creascope.plans.catalog import QUERIES  # noqa: E402
from creascope.session import build_session  # noqa: E402
from creascope.sinks.tables import write_table  # noqa: E402
from creascope.sources.files import read_inventory  # noqa: E402

HEADLINE = [
    "inventory_clean", "briefing_latest", "creative_kpis", "creative_metrics", "campaign_kpis",
    "design_flat", "creative_dimension", "linked_dataset", "linked_from_warehouse", "vision_join",
    "dashboard_stats", "top_features_10", "regression_metrics", "feature_medians", "feature_matrix",
    "group_fold_sizes", "baseline_benchmark", "pixel_measures", "image_measures",
    "standardized_embeddings", "heuristic_scores",
]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def event_reload(spark, folder: str) -> float:
    """Seconds to read the event log from CSV, clean it and store it as a table."""
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        Domain(spark, folder).raw_inventory.write.option("header", True).csv(f"{scratch}/csv")
        start = time.perf_counter()
        write_table(read_inventory(spark, f"{scratch}/csv"), f"{scratch}/raw_inventory")
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    finish(QUERIES["creative_metrics"](spark, folder))
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        finish(QUERIES[name](spark, folder))
        timings[name] = round(time.perf_counter() - start, 3)
    timings["event_reload"] = round(event_reload(spark, folder), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
