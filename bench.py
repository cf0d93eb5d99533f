"""Time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one line of JSON.

Each query is planned and run in full (all columns of all rows are computed and discarded), once to warm up and then
``BENCH_RUNS`` times; the best time counts.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session("bench", cores)
    times = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cores, "runs": runs,
    }))


if __name__ == "__main__":
    main()
