"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_QUERIES=all (or a comma list)
chooses other queries. Each query runs once to warm up and then BENCH_RUNS times; the
median counts. Results are computed in full and written to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.plans import catalog
from tidemark.session import build_session

HEADLINE = [
    # scans, projections, joins
    "march_orders", "line_revenue", "orders_customer", "semi_orders", "anti_customer",
    "star_revenue", "salted_join", "hybrid_join", "co_purchase", "asof_events", "point_in_time",
    # aggregates
    "nation_summary", "customer_summary", "product_summary", "category_summary", "cohorts",
    "whales", "median_diff", "rollup_daily", "salted_agg", "sketch_members",
    # windows and runs
    "customer_spend", "rolling7", "running_total", "rank_in_segment", "clv_rank",
    "top2_per_region", "islands_events", "sessions", "sessions_hot", "qualify_latest",
    # sets, changes, quality
    "skew_top", "dedup_latest", "exact_dups", "near_copies", "scd2_changes", "upsert",
    "change_feed", "dq_report", "dq_primary_key",
    # costs, questions, features, streams
    "cost_anomalies", "wow_drivers", "vector_topk", "sql_checks", "user_features", "psi",
    "rle", "stream_hourly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
