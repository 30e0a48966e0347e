"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import QUERIES

HEADLINE = [
    "coerce_types",
    "quarantine",
    "hourly_grid_summary",
    "daily_network_summary",
    "distinct_profile",
    "duplicate_grain",
    "cadence_gaps",
    "build_features",
    "leave_one_out_median",
    "prior_median",
    "rule_alerts",
    "detect_anomalies",
    "compare_detectors",
    "enrich_geometry",
    "nearby_grids",
    "features_as_of",
    "anomaly_as_of",
    "hotspots_each_hour",
    "top_grids",
    "network_summary",
    "upsert",
    "blocked_phrases",
    "split_chronological",
    "ingest_landing",
    "run_end_to_end",
    "train_tree",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridops-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["top_grids"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not timed
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
