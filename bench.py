"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query is built and fully executed (``noop`` sink, so the whole plan
runs without collecting rows) once as a warm-up and ``BENCH_REPEATS`` times
(default 3); the median wall time is reported.  Per query the JSON also
carries the shuffle bytes written by one timed run (from Spark's event log,
written to a scratch folder; the UI stays off) and whether the final
physical plan contains a single-partition exchange or a Cartesian product.
Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import get_spark  # noqa: E402

HEADLINE = [
    "flagship_region_rmse",
    "agg_profile",
    "nul_interpolate",
    "nul_hierarchical_fill",
    "enc_label_unseen",
    "enc_target_mean",
    "geo_transport_step",
    "agg_word_counts_top100",
    "sel_cramers_v",
    "scl_yeo_johnson",
    "eva_kfold_group_mean",
    "clu_dbscan",
]


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Sum shuffle bytes written per job group from a Spark event log."""
    stage_group, out = {}, {}
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f)]
    for path in sorted(files):
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = grp
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    grp = stage_group.get(info["Stage ID"])
                    if not grp:
                        continue
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            out[grp] = out.get(grp, 0) + int(acc.get("Value", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    log_dir = tempfile.mkdtemp(prefix="tessera-eventlog-", dir="/tmp")
    spark = get_spark(cores=cpus, shuffle_partitions=max(4, int(cpus) * 2), app="tessera-bench",
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                             "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    reg = load_all()
    times, flags = {}, {}
    for name in names:
        fn = reg[name].fn

        def once(group: str | None = None):
            if group:
                sc.setJobGroup(group, group)
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            sc.setJobGroup("untracked", "untracked")
            return dt, df

        _, df = once()  # warm-up
        plan = df._jdf.queryExecution().executedPlan().toString()
        flags[name] = {"single_partition": "SinglePartition" in plan, "cartesian": "CartesianProduct" in plan}
        runs = [once(name if i == 0 else None)[0] for i in range(repeats)]
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    shuffle = shuffle_bytes_by_group(log_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "repeats": repeats, "shuffle_bytes": {n: shuffle.get(n, 0) for n in names},
                      "plan_flags": flags}))


if __name__ == "__main__":
    main()
