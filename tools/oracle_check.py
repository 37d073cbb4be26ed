"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]

Prints one line per query: row counts, column match, exact value match
(values as text after sorting columns by name and rows), and a tolerant
float match for diagnosis.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import get_spark  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def close(a, b, tol=1e-9) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=tol, abs_tol=tol)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y, tol) for x, y in zip(a, b))
    return a == b


def compare(sp: pd.DataFrame, dk: pd.DataFrame) -> dict:
    res = {"rows_spark": len(sp), "rows_oracle": len(dk),
           "cols_match": sorted(sp.columns) == sorted(dk.columns)}
    if not res["cols_match"]:
        res["cols"] = (sorted(sp.columns), sorted(dk.columns))
        return res
    a, b = rows_of(sp), rows_of(dk)
    res["exact"] = [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]
    tol_ok = len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    res["tolerant"] = tol_ok
    if not tol_ok:
        for x, y in zip(a, b):
            if not close(x, y):
                res["first_diff"] = (x, y)
                break
    return res


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    reg = load_all()
    names = args.names or list(reg)
    spark = get_spark()
    con = duck(args.sf)
    bad = 0
    for name in names:
        q = reg[name]
        t0 = time.time()
        try:
            sp = q.fn(spark, args.sf).toArrow().to_pandas(types_mapper=pd.ArrowDtype)
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if q.oracle is None:
            print(f"\n{name:40s} rows={len(sp):7d} (no oracle) {dt:5.1f}s")
            continue
        try:
            dk = con.execute(q.oracle).to_arrow_table().to_pandas(types_mapper=pd.ArrowDtype)
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        r = compare(sp, dk)
        ok = r.get("exact", False)
        bad += not ok
        extra = "" if ok else f" {r}"
        print(f"\n{name:40s} rows={len(sp):7d}/{len(dk):7d} exact={ok} tol={r.get('tolerant')} {dt:5.1f}s{extra[:600]}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
