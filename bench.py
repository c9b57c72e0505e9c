"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is executed in full: its result goes to the ``noop`` sink, all columns.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lotseries.bindings.queries import QUERIES
from lotseries.session import prepare

HEADLINE = [
    "master_left_join",
    "valid_cycles",
    "ml_dataset",
    "renovation_report",
    "age_with_ratoon",
    "history_traces",
    "match_sources",
    "source_summary",
    "residual_histogram",
    "ols_cross_validation",
    "ols_holdout",
    "huber_final",
    "apply_correction",
    "index_algebra",
    "zonal_stats",
    "bilinear_resample",
    "extract_scenes",
    "extract_rasters",
    "best_scene",
    "tile_assignment",
    "complete_dates",
    "numeric_inference",
    "report_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lotseries-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    prepare(spark).sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
