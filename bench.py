"""Time every registered query; one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores, BENCH_RUNS the runs per query, of which
the median counts. Results go to the `noop` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from tidemark.session import build_session


def seconds(run, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(QUERIES["delta_endpoints"], spark, sf_dir)  # starts the JVM's code paths
    times = {}
    for name in chosen:
        times[name] = round(statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
