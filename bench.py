"""Time every query on the test tables and print one JSON line.

Each query is built and run to a sink that keeps nothing, once to warm up and then BENCH_RUNS times; the
best time counts. Building includes the small jobs an operator runs to choose its plan, and writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

import checks.chains  # noqa: F401  registers the chain queries
from checks.queries import QUERIES
from millrace.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        timed(name)
        times[name] = round(min(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
