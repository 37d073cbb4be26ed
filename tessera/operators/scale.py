"""Scaling and distribution transforms (SCL-1 .. SCL-9).

Fitting is one aggregation per step returning a handful of numbers per
column (the count depends on columns, not rows); applying is one generated
``select`` of column expressions, so it stays in whole-stage codegen.
Power-transform lambdas are searched on a fixed grid with every candidate's
log-likelihood computed in the same aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles

# Lambda grid -2.0 .. 2.0 in steps of 0.1.
LAMBDA_GRID = tuple(round(-2.0 + 0.1 * i, 1) for i in range(41))


def standard_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """SCL-1 fit: mean and population std (ddof 0); std 0 -> 1."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def minmax_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """SCL-2 fit: min and range; a zero range -> 1."""
    row = df.agg(*[F.min(c).cast("double").alias(f"a{i}") for i, c in enumerate(cols)],
                 *[F.max(c).cast("double").alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"a{i}"], (row[f"b{i}"] - row[f"a{i}"]) or 1.0) for i, c in enumerate(cols)}


def robust_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """SCL-3 fit: median and IQR (exact quantiles); IQR 0 -> 1."""
    q = quantiles(df, list(cols), [0.25, 0.5, 0.75])
    return {c: (q[(c, 0.5)], (q[(c, 0.75)] - q[(c, 0.25)]) or 1.0) for c in cols}


def affine(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """Apply (x - center) / scale for fitted params (any of SCL-1/2/3)."""
    exprs = {c: ((F.col(c) - F.lit(a)) / F.lit(b)) for c, (a, b) in params.items()}
    if suffix:
        return df.select("*", *[e.alias(f"{c}{suffix}") for c, e in exprs.items()])
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def skewness_g1(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """SCL-4: adjusted Fisher-Pearson skewness G1 (pandas ``skew``):
    G1 = g1 * sqrt(n (n-1)) / (n-2), from Spark's population g1."""
    row = df.agg(*[F.skewness(c).alias(f"g{i}") for i, c in enumerate(cols)],
                 *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        g, n = row[f"g{i}"], row[f"n{i}"]
        out[c] = None if g is None or n < 3 else g * math.sqrt(n * (n - 1)) / (n - 2)
    return out


def log_shift_params(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """SCL-5 fit: train minimum per column."""
    row = train.agg(*[F.min(c).cast("double").alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def log_shift(df: DataFrame, mins: dict[str, float]) -> DataFrame:
    """SCL-5 apply: log1p(x - min_train + 1) = ln(x - min + 2); argument <= 0 -> null."""
    def e(c, m):
        a = F.col(c) - F.lit(m) + F.lit(2.0)
        return F.when(a > 0, F.ln(a))
    return df.select(*[e(c, mins[c]).alias(c) if c in mins else F.col(c) for c in df.columns])


def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson transform for one lambda."""
    pos = F.ln(x + 1) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
    neg = -F.ln(-x + 1) if abs(lam - 2) < 1e-12 else -(F.pow(-x + 1, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def box_cox(x: Column, lam: float) -> Column:
    return F.ln(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1) / F.lit(lam)


def power_lambda(df: DataFrame, col: str, method: str = "yeo-johnson",
                 grid: Sequence[float] = LAMBDA_GRID) -> tuple[float, float]:
    """SCL-6/7: maximum-likelihood lambda on the grid, all candidates in one
    aggregation.  Returns (lambda, log-likelihood)."""
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    if method == "yeo-johnson":
        jac = F.sum(F.signum(x) * F.ln(F.abs(x) + 1))
        tf = yeo_johnson
    elif method == "box-cox":
        jac = F.sum(F.ln(x))
        tf = box_cox
    else:
        raise ValueError(method)
    aggs = [F.count(x).alias("n"), jac.alias("j")]
    aggs += [F.var_pop(tf(x, lam)).alias(f"v{i}") for i, lam in enumerate(grid)]
    row = data.agg(*aggs).first()
    n, j = row["n"], row["j"]
    best = None
    for i, lam in enumerate(grid):
        v = row[f"v{i}"]
        if v is None or v <= 0:
            continue
        llf = -n / 2.0 * math.log(v) + (lam - 1) * j
        if best is None or llf > best[1]:
            best = (lam, llf)
    return best if best else (1.0, float("nan"))


def power_lambda_refined(df: DataFrame, col: str, method: str = "yeo-johnson") -> tuple[float, float]:
    """SCL-6 with one refine pass: the 0.1-step grid, then a 0.01-step grid
    around its best value, each in one aggregation."""
    lam0, llf0 = power_lambda(df, col, method)
    fine = [round(lam0 + 0.01 * i, 2) for i in range(-9, 10)]
    lam1, llf1 = power_lambda(df, col, method, grid=fine)
    return (lam1, llf1) if llf1 >= llf0 else (lam0, llf0)


def power_transform(df: DataFrame, col: str, lam: float, method: str = "yeo-johnson",
                    standardize: bool = True, fit_df: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """SCL-6/7 apply: transform with ``lam`` then (optionally) standardise
    with mean / population std of the transformed fit data."""
    out = out or col
    tf = yeo_johnson if method == "yeo-johnson" else box_cox
    expr = tf(F.col(col).cast("double"), lam)
    if standardize:
        src = fit_df if fit_df is not None else df
        row = src.select(expr.alias("_t")).agg(F.avg("_t").alias("m"), F.stddev_pop("_t").alias("s")).first()
        expr = (expr - F.lit(row["m"])) / F.lit(row["s"] or 1.0)
    if out == col:
        return df.select(*[expr.alias(c) if c == col else F.col(c) for c in df.columns])
    return df.select("*", expr.alias(out))


def choose_power(df: DataFrame, col: str) -> tuple[str, float | None]:
    """SCL-7: Box-Cox if every value > 0 else Yeo-Johnson; constant -> skip."""
    row = df.agg(F.min(col).alias("a"), F.max(col).alias("b")).first()
    if row["a"] is None or row["a"] == row["b"]:
        return "skip", None
    method = "box-cox" if row["a"] > 0 else "yeo-johnson"
    return method, power_lambda(df, col, method)[0]


def auto_scaler_params(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                       skew_limit: float = 1.0) -> list[tuple]:
    """SCL-8 fit: per column (column, kind, center, scale, lambda).

    categorical -> standard; |G1| > limit -> robust then Yeo-Johnson (lambda
    fitted on the robust-scaled train values, then standardised); else robust."""
    rows = []
    std = standard_params(train, list(categorical)) if categorical else {}
    for c in categorical:
        rows.append((c, "standard", float(std[c][0]), float(std[c][1]), None, None, None))
    g1 = skewness_g1(train, list(numeric)) if numeric else {}
    rob = robust_params(train, list(numeric)) if numeric else {}
    for c in numeric:
        med, iqr = rob[c]
        if g1[c] is not None and abs(g1[c]) > skew_limit:
            scaled = train.select(((F.col(c) - F.lit(med)) / F.lit(iqr)).alias(c))
            lam, _ = power_lambda(scaled, c, "yeo-johnson")
            t = yeo_johnson(F.col(c), lam)
            s = scaled.agg(F.avg(t).alias("m"), F.stddev_pop(t).alias("s")).first()
            rows.append((c, "robust+yeo-johnson", float(med), float(iqr), float(lam), s["m"], s["s"] or 1.0))
        else:
            rows.append((c, "robust", float(med), float(iqr), None, None, None))
    return rows


def apply_auto_scaler(df: DataFrame, params: list[tuple]) -> DataFrame:
    """SCL-8 apply: one select over the parameter rows (train and test alike)."""
    exprs = {}
    for c, kind, a, b, lam, m, s in params:
        e = (F.col(c) - F.lit(a)) / F.lit(b)
        if kind == "robust+yeo-johnson":
            e = (yeo_johnson(e, lam) - F.lit(m)) / F.lit(s)
        exprs[c] = e
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def skew_bundle(train: DataFrame, test: DataFrame, cols: Sequence[str], threshold: float = 0.5):
    """SCL-9: G1 test; right-skewed columns get the log shift (train min),
    left-skewed a Yeo-Johnson fitted on train; then robust scaling fitted on
    train.  Returns (train, test, report rows)."""
    g1 = skewness_g1(train, list(cols))
    report = []
    for c in cols:
        g = g1[c]
        if g is not None and g > threshold:
            mins = log_shift_params(train, [c])
            train, test = log_shift(train, mins), log_shift(test, mins)
            report.append((c, float(g), "log_shift"))
        elif g is not None and g < -threshold:
            lam, _ = power_lambda(train, c, "yeo-johnson")
            fit = train
            train = power_transform(train, c, lam, fit_df=fit)
            test = power_transform(test, c, lam, fit_df=fit)
            report.append((c, float(g), f"yeo-johnson({lam})"))
        else:
            report.append((c, None if g is None else float(g), "none"))
    rob = robust_params(train, list(cols))
    return affine(train, rob), affine(test, rob), report
