"""Time every registered query and print one JSON line.

``BENCH_SF_DIR``  data folder (default /root/testdata/sf0.1)
``BENCH_CPUS``    local cores (default 8)
``BENCH_RUNS``    timed runs per query after one warm-up run; the median counts (default 3)
``BENCH_QUERIES`` comma-separated names (default: all)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

import workload  # noqa: E402
from keypanel.session import RECOMMENDED  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(workload.QUERIES)

    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("keypanel-bench")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", cpus))
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({"metric": "total query time, median of warm runs", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
