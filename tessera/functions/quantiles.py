"""Exact quantiles by distributed selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer, and for a global quantile that buffer lands in one task.  Here the
value at a given rank is found by narrowing a bracket instead:

1. one aggregation counts non-null values per column;
2. while a bracket still holds many distinct values, ``percentile_approx``
   (a bounded sketch) proposes a tighter bracket around the wanted rank, and
   one more aggregation counts the values below and inside it (each round
   shrinks the bracket by about ``accuracy / 6``);
3. once the bracket is small, its rows are reduced to (value, count) pairs,
   a running count per bracket finds the exact value.

Interpolation is the linear rule shared by pandas ``quantile``, Spark
``percentile`` and DuckDB ``quantile_cont``.  Only the final scalars reach
the driver (their number depends on columns x probabilities, not rows).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _in(c, lo, hi):
    x = F.col(c)
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & (x >= F.lit(lo))
    if hi is not None:
        cond = cond & (x <= F.lit(hi))
    return cond


def values_at_ranks(df: DataFrame, targets: Sequence[tuple[str, int]], small: int = 200_000,
                    accuracy: int = 10_000) -> dict[tuple[str, int], float]:
    """Exact value at 0-based rank ``r`` among non-null, ascending values of ``c``."""
    targets = list(dict.fromkeys(targets))
    state = {t: [None, None] for t in targets}  # bracket [lo, hi], inclusive
    result: dict[tuple[str, int], float] = {}
    cols = sorted({c for c, _ in targets})
    src = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    while pending := [t for t in targets if t not in result]:
        before = {t: list(state[t]) for t in pending}
        aggs = []
        for i, (c, r) in enumerate(pending):
            lo, hi = state[(c, r)]
            inside = _in(c, lo, hi)
            below = F.col(c) < F.lit(lo) if lo is not None else F.lit(False)
            aggs += [F.count_if(below).alias(f"b{i}"), F.count_if(inside).alias(f"n{i}"),
                     F.approx_count_distinct(F.when(inside, F.col(c))).alias(f"d{i}")]
        row = src.agg(*aggs).first()
        exact, wide = [], []
        for i, t in enumerate(pending):
            b, n, d = row[f"b{i}"], row[f"n{i}"], row[f"d{i}"]
            r = t[1]
            if not (b <= r < b + n):  # the sketch missed: widen that side
                lo, hi = state[t]
                state[t] = [lo if r >= b else None, hi if r < b + n else None]
                continue
            (exact if d <= small else wide).append((t, b, n))
        if exact:
            result.update(_exact_stage(src, exact, state))
        if wide:
            aggs = []
            for i, (t, b, n) in enumerate(wide):
                c, r = t
                lo, hi = state[t]
                q = (r - b) / max(n - 1, 1)
                eps = 3.0 / accuracy
                qs = [max(0.0, q - eps), min(1.0, q + eps)]
                aggs.append(F.percentile_approx(F.when(_in(c, lo, hi), F.col(c)), qs, accuracy).alias(f"p{i}"))
            prow = src.agg(*aggs).first()
            for i, (t, b, n) in enumerate(wide):
                lo, hi = state[t]
                q = (t[1] - b) / max(n - 1, 1)
                plo, phi = prow[f"p{i}"]
                new_lo = lo if q - 3.0 / accuracy <= 0 else plo
                new_hi = hi if q + 3.0 / accuracy >= 1 else phi
                state[t] = [new_lo, new_hi]
        if all(state[t] == before[t] and t not in result for t in pending):
            raise RuntimeError(f"no bracket of {pending} gets smaller; raise accuracy or small")
    return result


def _exact_stage(src: DataFrame, items, state):
    """Exact pick inside small brackets: (value, count) pairs + running count.

    Targets sharing a column and bracket share one scan group."""
    groups: dict[tuple, int] = {}
    for t, _, _ in items:
        groups.setdefault((t[0], *state[t]), len(groups))
    structs = [F.when(_in(c, lo, hi), F.struct(F.lit(g).alias("t"), F.col(c).alias("x")))
               for (c, lo, hi), g in groups.items()]
    pairs = (src.select(F.explode(F.array(*structs)).alias("s")).where(F.col("s").isNotNull())
             .select("s.t", "s.x").groupBy("t", "x").count())
    w = Window.partitionBy("t").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    cum = pairs.withColumn("cum", F.sum("count").over(w))
    want = [(groups[(t[0], *state[t])], t[1] - b) for t, b, _ in items]
    cond = F.lit(False)
    for g, k in dict.fromkeys(want):
        cond = cond | ((F.col("t") == g) & (F.col("cum") - F.col("count") <= k) & (F.col("cum") > k))
    got = [(r["t"], r["cum"] - r["count"], r["cum"], r["x"]) for r in cum.where(cond).select("t", "x", "count", "cum").collect()]
    out = {}
    for (t, _, _), (g, k) in zip(items, want):
        out[t] = next((x for gg, a, b, x in got if gg == g and a <= k < b), None)
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles for each (column, probability)."""
    small = kw.get("small", 200_000)
    stats = df.agg(*[F.count(F.col(c)).alias(c) for c in cols],
                   *[F.approx_count_distinct(F.col(c)).alias(f"_d_{c}") for c in cols]).first()
    counts = {c: stats[c] for c in cols}
    plan, targets = {}, []
    for c in cols:
        n = counts[c]
        for p in probs:
            if n == 0:
                plan[(c, p)] = None
                continue
            h = (n - 1) * p
            lo = int(math.floor(h))
            hi = min(lo + 1, n - 1)
            plan[(c, p)] = (lo, hi, h - lo)
            targets += [(c, lo), (c, hi)]
    # columns with few distinct values go straight to the exact pick
    direct = [t for t in dict.fromkeys(targets) if stats[f"_d_{t[0]}"] <= small]
    rest = [t for t in targets if t not in set(direct)]
    vals = {}
    if direct:
        src = df.select(*[F.col(c).cast("double").alias(c) for c in sorted({c for c, _ in direct})])
        vals.update(_exact_stage(src, [(t, 0, counts[t[0]]) for t in direct], {t: [None, None] for t in direct}))
    if rest:
        vals.update(values_at_ranks(df, rest, **kw))
    out = {}
    for (c, p), spec in plan.items():
        if spec is None:
            out[(c, p)] = None
            continue
        lo, hi, frac = spec
        a, b = vals[(c, lo)], vals[(c, hi)]
        out[(c, p)] = a if frac == 0 or a == b else a + (b - a) * frac
    return out


def quartiles(df: DataFrame, col: str, **kw) -> tuple[float | None, float | None]:
    q = quantiles(df, [col], [0.25, 0.75], **kw)
    return q[(col, 0.25)], q[(col, 0.75)]
