"""Benchmark of the headline marts.

Runs each headline query on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one warm-up
run, then ``$BENCH_REPEATS`` (default 3) timed runs executed in full
through the ``noop`` sink (no collect to the driver). Prints one JSON
line; ``value`` is the sum of the per-query medians. ``build`` and ``run``
part each query's time into making the DataFrame (analysis and the size
checks of lookup tables) and running it, ``jobs`` counts the Spark jobs of
one run in both parts, and ``first`` is the untimed warm-up's time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.queries import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    "gold_agg_rig_earthquake",
    "state_rig_count",
    "earthquake_ranking",
    "nearest_place",
    "silver_rig_counts",
    "silver_earthquake_with_location",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_JAVA_OPTS"):
        extra["spark.driver.extraJavaOptions"] = os.environ["BENCH_JAVA_OPTS"]
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # a scratch folder, for tools/stage_times.py
    if log_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark = build_session(f"local[{cpus}]", app_name="quarry-bench", shuffle_partitions=cpus * 2, extra=extra)
    timings: dict[str, float] = {}
    parts: dict[str, dict[str, float]] = {"build": {}, "run": {}, "first": {}}
    jobs: dict[str, list[int]] = {}
    sc = spark.sparkContext
    for name in names:
        runs = []
        for i in range(repeats + 1):
            sc.setJobGroup(f"{name} {i} build", f"{name} run {i}, build")
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            t1 = time.perf_counter()
            sc.setJobGroup(f"{name} {i} run", f"{name} run {i}")
            df.write.format("noop").mode("overwrite").save()
            t2 = time.perf_counter()
            if i:
                runs.append((t2 - t0, t1 - t0, t2 - t1))
            else:
                parts["first"][name] = round(t2 - t0, 3)
        for k, of in enumerate((timings, parts["build"], parts["run"])):
            of[name] = round(statistics.median(r[k] for r in runs), 3)
        jobs[name] = [len(sc.statusTracker().getJobIdsForGroup(f"{name} {repeats} {part}")) for part in ("build", "run")]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_marts_median_sum",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        **parts,
        "jobs": jobs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
