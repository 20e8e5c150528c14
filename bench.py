"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR names the dataset folder, BENCH_CPUS the cores, BENCH_RUNS the timed
runs per query after one warm-up, BENCH_QUERIES an optional comma-separated subset.
Each run evaluates the whole result into Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fillscope.plans.registry import QUERIES
from fillscope.scale import stages
from fillscope.session import local_session

HEADLINE = (
    "tokens",
    "win_rate_leaderboard",
    "trader_counts",
    "trader_counts_stream",
    "trades_by_maker",
    "trades_sampled",
    "exact_address",
    "trades_with_time",
    "positions",
    "user_trades",
    "user_pnl",
    "trader_stats",
    "trade_categories",
    "trader_primary_category",
    "updated_trader_stats",
    "trade_activity_by_category",
    "category_distribution",
    "two_sided_positions",
    "winrate_proxy",
    "trader_features",
    "cluster_report",
    "cluster_legend",
    "viz_points",
    "axis_profile",
    "sampled_trader_stats",
    "kmeans_check",
    "projection_check",
    "clustered_traders",
    "bucketed_positions",
    "address_index",
    "trades_of_days",
    "trader_counts_loaded",
    "reject_counts",
    "nth_fill",
    "dataset_profile",
    "layout_check",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        times = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            with stages(spark):
                QUERIES[name](spark, folder).write.mode("overwrite").format("noop").save()
                if attempt:
                    times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
