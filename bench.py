"""Time the queries of the library: one JSON line on stdout.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma list).
Each query is planned and run to a sink that keeps every row; the time is the better of
BENCH_RUNS runs after the session is warm.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from docketflow.session import local_session  # noqa: E402


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n] or list(QUERIES)
    spark = local_session(cpus, app="docketflow-bench")
    timed(lambda: spark.read.parquet(f"{sf_dir}/orders.parquet"))
    seconds = {
        name: round(min(timed(lambda n=name: QUERIES[n](spark, sf_dir)) for _ in range(runs)), 3)
        for name in names
    }
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
