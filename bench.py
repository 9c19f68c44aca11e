"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf"}.
Each query: one warm-up run (all queries first), then the median of
$BENCH_REPEATS runs taken round-robin over the queries; a run builds the
query and writes its whole result to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "catalog_products",
    "last_ver_left_join",
    "last_version_per_key",
    "categories_full",
    "categories_incremental",
    "bronze_sellers",
    "nav_links",
    "cards_dialect_a",
    "cards_dialect_b",
    "cards_dialect_c",
    "bronze_products",
    "seq_ids_scaled",
    "seq_ids_hot_key",
    "overwrite_partition",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="vitrine-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitrine-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
        .config("spark.sql.adaptive.enabled", "true")
        # small inputs, CPU-bound parsing: keep AQE from folding all rows into one task
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", os.environ.get("BENCH_ADVISORY", "1m"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))

    from vitrine.queries import QUERIES
    from vitrine.session import configure

    configure(spark)
    names = only or HEADLINE

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Every query is warmed up first, then the timed repeats go round-robin:
    # in one JVM the code compiled for one query's hot paths changes the
    # next query's speed, so all queries are timed in the same mixed steady
    # state instead of right after their own warm-up.
    warm = {name: run_once(name) for name in names}
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(repeats):
        for name in names:
            runs[name].append(run_once(name))
    times: dict[str, float] = {}
    for name in names:
        times[name] = round(statistics.median(runs[name]), 3)
        print(f"# {name}: {times[name]}s (warm-up {warm[name]:.2f}s)", file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
