"""Time the headline queries: one JSON line, seconds per query.

Each query is executed in full into the no-op sink. ``prepare`` is the time to
write the shared event log with deltas that the other queries read.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import fixture
from checks.queries import all_queries

HEADLINE = (
    "scan_event_log",
    "event_deltas",
    "session_distincts",
    "numeric_stats",
    "numeric_quantiles",
    "value_stats_one_pass",
    "by_event_name_quantiles",
    "word_features",
    "milestone_features",
    "level_time_features",
    "above_threshold_features",
    "frequent_fqid_level_room",
    "combo_features",
    "repeat_clicks",
    "navigate_category_counts",
    "room_grid_counts",
    "room_grid_scaled",
    "join_feature_blocks",
    "feature_summary",
    "prune_features",
    "cumulative_group_merge",
    "fill_missing_features",
    "chain_features",
    "threshold_sweep",
    "macro_f1_by_question",
    "truth_matrix",
    "oof_boosted",
    "oof_forest",
    "oof_boosted_early_stop",
    "oof_weighted",
    "train_final",
    "save_models",
    "room_grid_pca",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sessionweave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/events.parquet").count()  # JVM warm-up

    times = {}
    start = time.time()
    fixture.log(spark, sf)
    times["prepare"] = round(time.time() - start, 3)
    queries = all_queries()
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
