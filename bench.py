"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS
(warm runs per query, median taken), BENCH_ONLY (comma-separated name parts),
BENCH_SCRATCH (the shared folder of stored stages).
Every query is built and fully computed into a ``noop`` sink. Queries that
train a model run once; the others run once to warm up first.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from shelfwise.queries import QUERIES, SQL
from shelfwise.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
ONLY = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]


def main() -> None:
    spark = build_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__checkpoint__dir=os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in QUERIES:
        if ONLY and not any(p in name for p in ONLY):
            continue
        if name in SQL:
            first = run(name)
            # Long queries are warm by the time they end; one more run will do.
            runs = RUNS if first < 5 else 1
        else:
            runs = 1
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
