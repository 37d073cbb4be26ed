"""Scan the physical plans of all registered queries for single-partition
exchanges, Cartesian products and nested-loop joins; report scans that read
more columns than needed is left to reading ``explain``.

    python tools/plan_audit.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import get_spark  # noqa: E402

PATTERNS = ["SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    spark = get_spark()
    for name in a.names or list(reg):
        df = reg[name].fn(spark, a.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = {p: len(re.findall(p, plan)) for p in PATTERNS}
        hits = {k: v for k, v in hits.items() if v}
        print(f"{name:40s} {hits if hits else 'clean'}")
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
