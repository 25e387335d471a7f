"""Time the catalogue's queries and print one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma list; default the headline queries, `all` for every query
BENCH_RUNS     warm runs per query, the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wireglass.queries import QUERIES
from wireglass.session import build_session

HEADLINE = [
    "view_last_n",
    "view_part1",
    "view_part2",
    "view_last_batch",
    "view_trigger_m",
    "view_query_named",
    "view_json",
    "view_latest",
    "answer_view_requests",
    "route_requests",
    "parse_parameters",
    "inject_tuple",
    "inject_xml",
    "tracking_key",
    "correlate",
    "unmatched_responses",
    "request_metrics",
    "active_gauge",
    "ws_assemble",
    "ws_sessions",
    "ws_fanout",
    "ws_sent",
    "position_diff",
    "live_table",
    "stream_last_n",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session("bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        # the first run compiles and is not counted
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name} {seconds[name]} (first {times[0]:.2f})", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
