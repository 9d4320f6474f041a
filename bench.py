"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row computed,
nothing collected to the driver). Prints ONE JSON line on stdout:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (runs per query, median reported; default 1), BENCH_QUERIES
(comma list to override the headline set).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rate_more_products",
    "rate_more_recently_products",
    "average_products",
    "itemcf_top10",
    "content_similar_exact",
    "als_user_recs",
    "als_item_similar",
    "realtime_scores",
    "served_hot",
    "served_itemcf",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from tastegraph.plans.registry import queries
    from tastegraph.session import build_session

    # Local tuning: 2 shuffle partitions per core and no post-shuffle coalescing.
    # The heavy stages here are CPU-bound (pair aggregation, top-k sorts);
    # coalescing them to ~cores+1 tasks leaves a straggler wave on one machine.
    # On a cluster keep the library default (coalescing on).
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        driver_memory="16g",
        extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"},
    )
    qs = queries()
    # JVM / Python worker warm-up on a tiny scan (not timed).
    qs["products_typed"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    results: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(runs), 3)
        print(f"{name}: {results[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
