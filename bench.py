"""Times the registered queries and prints one JSON line.

Each query runs once to warm up and BENCH_RUNS (3) times more; its value is the median. The
result of a query is consumed in full without being kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from aerolake.plans.catalog import queries
from aerolake.session import local_session


def staged(spark, sf_dir: str, parts: int) -> str:
    """The same tables with the large ones in as many files as there are cores.

    The test tables are one file each and would occupy one core. Clusters read tables of many files.
    """
    folder = tempfile.mkdtemp(prefix="aerolake-bench-")
    for name in ("events", "orders", "nation", "region"):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        several = name in ("events", "orders")
        (table.repartition(parts) if several else table).write.parquet(f"{folder}/{name}.parquet")
    return folder


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "aerolake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(queries())
    tables = staged(spark, sf_dir, int(cpus))
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            consume(queries()[name](spark, tables))
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "events": events,
        "cpus": cpus,
        "runs": runs,
        "enrich_rows_per_sec": round(events / seconds["enrich_states"]) if "enrich_states" in seconds else None,
    }))


if __name__ == "__main__":
    main()
