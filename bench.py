"""Time the headline queries and print one JSON line.

Each query runs once cold, which is discarded, and then up to three times warm; the
median counts. Results are forced with the noop sink. Nothing is cached between runs.
Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. BENCH_SECONDS (default 1200)
bounds the whole run: once it is spent, a query is timed by its first run only.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradepanel.catalog import runners  # noqa: E402

HEADLINE = [
    "trade_balance", "pair_distance", "agreement_adjust", "tariff_profile", "panel_build", "geo_score",
    "normalise_to_ref", "cross_rate", "yearly_totals", "rollup_all_products", "union_history_forecast",
    "lag_features", "pct_change", "global_shift", "row_index", "group_median", "target_stats", "autocorr",
    "distinct_rows", "dedupe_by_key", "quality_profile", "top_products", "share_of_total", "log_features",
    "standard_scale", "time_folds", "cv_metrics", "ols_gram", "ols_fit", "ridge_search", "roll_linear",
    "log_correction", "unpivot_years", "partner_semi", "json_flatten", "sink_roundtrip", "dash_series",
]
WARM_RUNS = 3


def once(spark, run, folder) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    spark.catalog.clearCache()
    return took


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    budget = float(os.environ.get("BENCH_SECONDS", "1200"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tradepanel-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = runners()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    begin = time.perf_counter()
    seconds = {}
    for name in names:
        cold = once(spark, known[name], folder)
        warm = []
        while len(warm) < WARM_RUNS and time.perf_counter() - begin < budget:
            warm.append(once(spark, known[name], folder))
        seconds[name] = round(statistics.median(warm or [cold]), 3)
        print(f"{name:24s} cold {cold:6.2f}  warm {seconds[name]:6.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
