"""Headline-query benchmark.

Runs the headline queries over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the no-op sink (every row computed, nothing
collected); the time is the best of ``$BENCH_REPEATS`` runs (default 2) after one
warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("controls_maz", "seed_persons", "forecast_maz", "validation_persons",
            "zonal_residence", "balance_weights")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from popweave.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2), app_name="popweave-bench")

    from popweave.plans.catalog import QUERIES

    def run(name: str) -> float:
        spark.catalog.clearCache()  # no run profits from an earlier run's cache
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("controls_maz")  # warm-up: JVM, codegen, file listing
    times: dict[str, float] = {}
    for name in names:
        reps = 1 if name in ("balance_weights", "balance_residual", "synthesize") else repeats
        times[name] = round(min(run(name) for _ in range(reps)), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
