"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up run, then three timed runs whose median
is reported.  A run executes the whole plan into Spark's ``noop`` sink (no
collect to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardflow.plans.registry import load_all  # noqa: E402
from wardflow.session import build_session  # noqa: E402

HEADLINE = [
    "hourly_median",           # flagship: trim + hourly median
    "hourly_panel_classwise",  # class-wise pivot (median / sum / first)
    "dense_grid",              # dense hourly grid
    "interp_both",             # per-entity window interpolation
    "loo_residual",            # leave-one-out residuals
    "missing_runs",            # gaps and islands
    "asof_next_stay",          # as-of stay attribution
    "stay_rollup",             # per-stay aggregation with dimension joins
    "scenario_errors",         # masking x imputers x metrics
    "roc_auc_by_group",        # classifier metric
    "profile",                 # dataset profile
    "series_features",         # per-series features
]


def _driver_memory() -> str:
    """Half of the machine's memory, at most 16 GB (local mode: the driver
    JVM is the whole cluster)."""
    total = None
    try:
        with open("/proc/meminfo") as f:
            total = int(next(line for line in f if line.startswith("MemTotal")).split()[1]) * 1024
    except (OSError, StopIteration, ValueError):
        pass
    for path in ("/sys/fs/cgroup/memory.max", "/sys/fs/cgroup/memory/memory.limit_in_bytes"):
        try:
            with open(path) as f:
                v = f.read().strip()
            if v.isdigit():
                total = min(total or int(v), int(v))     # container limit, when set
        except OSError:
            continue
    if not total:
        return "4g"
    return f"{max(1, min(16, total // (2 << 30)))}g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="wardflow-bench",
                          driver_memory=_driver_memory())
    queries, _ = load_all()
    times: dict[str, float] = {}
    for name in names:
        fn = queries[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
