"""Time the headline queries: one JSON line on standard output.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Arguments name queries to
time instead of the headline list; ``all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "similar_day_forecast", "similar_days_by_rank", "neighbour_columns", "blend_with_backfill", "similar_windows",
    "weekday_corrected", "weekday_factors", "binned_residual", "kernel_regression", "savgol_narrow", "median_filtered_wide",
    "rebuilt_from_ratio", "intraday_demand", "calendar_lags", "rolling_readings", "average_rank_global", "error_describe",
    "running_sum_cost_order", "forward_fill", "month_block_weekday_median", "latest_revision", "merit_order_surrender",
    "merit_order_lines", "net_dispatch", "bid_ladder", "position_gap", "upserted_rows", "band_of_schedule", "costs_in_force",
    "unique_checks", "problem_summary", "weather_payload", "html_table_cells", "block_window_sums",
)


def main(argv: list[str]) -> None:
    from wattframe.plans.registry import load_all
    from wattframe.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="16g", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = load_all()
    names = list(registered) if argv == ["all"] else (argv or list(HEADLINE))
    run = lambda name: registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        run(name)
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_warm_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
