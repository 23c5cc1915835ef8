"""Time the registered queries on local cores; prints one JSON line.

Every query runs to completion over its whole input into the no-op sink: once to warm up
code generation and Python workers, then ``BENCH_REPEATS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from folioweave.plans.catalogue import QUERIES
from folioweave.session import build_session


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    spark = build_session(f"local[{cpus}]", "folioweave-bench", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "folioweave.readPartitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    timings = {}
    for name in chosen:
        once(name)
        timings[name] = round(statistics.median(once(name) for _ in range(repeats)), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, timings[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
