"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up (default 3)
    BENCH_QUERIES comma-separated subset (default: all headline queries)

Each run executes the whole plan and discards the rows with the ``noop``
sink, so no result is collected to the driver. Reported per query: the
median of the timed runs, in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "click_counts_sliding", "click_first_event", "click_routes", "click_counts_stream",
    "telemetry_decode", "neighbours", "neighbours_split", "neighbours_global_key", "gaps", "gap_csv",
    "follower_changes",
    "neighbours_stream",
    "click_parse", "click_authenticated", "click_skipped", "click_counts_tumbling", "ten_or_more", "nine_or_less",
    "console_counts", "click_routes_stream", "telemetry_quality", "telemetry_status", "raw_dump", "gap_report",
    "adjacent_pairs", "follower_changes_stream", "neighbours_targets_table", "find_follower", "find_follower_stream",
    "pattern_pairs", "pattern_three_steps", "click_canonical", "click_first_event_stream", "telemetry_decode_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from racestream.session import build_session, clear_scratch, ship_package
    from racestream.plans.queries import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)

    def once(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    results, spread = {}, {}
    for name in names:
        once(name)  # warm-up
        times = [once(name) for _ in range(runs)]
        results[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "cores_of_the_machine": os.cpu_count(),
        "min_max": spread,
        "runs": runs,
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
