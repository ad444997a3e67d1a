"""Headline queries, warm, median of three; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default all) choose the input
and the number of local threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.plans import catalogue
from millrace.session import build_session

HEADLINE = [
    "revenue_by_month_brand", "shop_enriched_orders", "top3_brands_monthly", "yoy_revenue_compare", "events_by_grain_pt1h",
    "filter_where_having", "simple_metrics", "aggregate_operators", "aggregate_positions", "lines_deduplicated",
    "densify_events", "rolling7_event_mean", "rolling7_event_median", "cum_event_sum", "diff_event_value",
    "resample_6h_ffill", "resample_6h_linear", "resample_1d_sum", "forecast_event_value", "event_paths_len3",
    "pivot_priority_by_status", "pivot_totals_all_levels", "share_of_column", "region_nation_segment_rollup",
    "cdc_state", "cdc_history", "cdc_streamed_state", "boxplot_price_by_flag", "histogram_acctbal", "heatmap_norm",
    "ttest_event_types", "quality_lineitem", "geo_grid_p95", "geo_geohash_cells", "nation_flow_links", "nation_flow_matrix",
    "nation_hierarchy", "ip_ranges_join", "partitioned_first_load",
]


def run_once(spark, query, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    threads = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(threads), "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = catalogue()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        query = entries[name].run
        run_once(spark, query, folder)
        seconds[name] = round(statistics.median(run_once(spark, query, folder) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}
        )
    )


if __name__ == "__main__":
    main()
