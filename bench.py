"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query is
built and run to the end once after a warm-up, with every output column computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINES = (
    "m04_label_rates", "m04_label_store", "m07_silver_lms", "m07_silver_attributes_main", "m07_silver_financials_main",
    "m08_silver_financials_retrofit", "a01_click_averages", "j01_anchor_join_chain", "j03_raw_click_fan_out",
    "j04_features_labels", "m05_feature_store_main", "m06_feature_store_retrofit", "m10_stratified_split",
    "a06_model_summary", "w01_best_by_week", "e02_roc_auc", "e06_lift", "e08_score_histogram", "e11_averaged_metrics",
    "e14_default_report", "q01_psi", "q02_out_of_time", "q03_duplicate_report", "q04_missing_ids", "q05_null_profile",
    "q07_partition_comparison", "s07_overwrite_snapshots", "st01_file_arrival", "x04_batch_scoring", "a10_quantiles", "w04_row_numbers",
    "f25_label_codes", "m12_boosted_trees", "m13_boosted_early_stop",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.session import clear_scratch, get_spark
    from tidemark.suite import QUERIES

    spark = get_spark(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")

    jobs: dict[str, int] = {}

    def run(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        # jobs that staging, fits and counts run before the result is read show here too
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        clear_scratch(spark)
        return took

    run("a06_model_summary")
    wanted = sys.argv[1:] or HEADLINES
    times = {name: round(run(name), 3) for name in wanted}
    scale = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "jobs": {name: jobs[name] for name in wanted}, "sf": float(scale.group(1).rstrip(".")) if scale else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
