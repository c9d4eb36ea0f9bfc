"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     warm runs per query, the best counts (default 3)
BENCH_QUERIES  comma-separated names, or 'all'
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "player_action", "collusion_pairs", "win_lose_round", "player_profile", "player_style",
    "daily_overview", "explode_log", "game_result", "robot_stats_90d", "win_lose_u",
    "active_hours", "showdown_winners", "packed_equity", "player_bet_stats", "match_report",
    "latency_report", "fill_forward_back", "running_distinct", "log_ingest",
]


def main() -> None:
    from tablehouse.queries import all_queries
    from tablehouse.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = local_session(cpus, "bench")
    queries = all_queries()
    picked = list(queries) if wanted == "all" else [q for q in wanted.split(",") if q] or HEADLINE
    times = {}
    for name in picked:
        best = None
        for attempt in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt or not runs:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name:22s} {times[name]:7.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline query wall time, best warm run, total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
