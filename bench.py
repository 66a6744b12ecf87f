"""Benchmark: run every registered query on ``$BENCH_SF_DIR`` and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed in full with the ``noop`` sink (every row is produced, nothing is
collected to the driver), ``BENCH_RUNS`` times (default 2); a query's time is its best run, so
one-off JIT / code-generation warm-up of the first run is not counted. ``value`` is the sum of
the per-query seconds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from pyspark.sql import SparkSession

    from eventide.plans import REGISTRY
    from eventide.session import SESSION_DEFAULTS

    b = SparkSession.builder.master(f"local[{cpus}]").appName("eventide-bench")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
          .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventide-bench-ckpt-"))

    names = argv or list(REGISTRY)
    # warm-up: JVM, code generation and the parquet footer cache, not timed
    for warm in ("tumble_1h", "dedup_last"):
        REGISTRY[warm].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    for name in names:
        best = None
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            timings[name] = round(best, 3)
        except Exception as e:  # keep going; report the failure in the JSON line
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "n_queries": len(timings),
        "runs_per_query": runs,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
