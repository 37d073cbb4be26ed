"""Feature selection (SEL-1 .. SEL-14).

Filter methods reduce to a few shared aggregates computed in one pass each:
population variances, the pairwise correlation table, the Gram matrix, and
contingency counts ``(c1, c2, v1, v2, n)``.  Only k x k matrices (k = number
of columns) reach the driver, e.g. for the VIF inverse.  Wrapper methods
(RFE, forward selection) loop over ``pyspark.ml`` fits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..sources.store import cut_lineage
from .nulls import fill_by_strategy, inf_to_null_cols
from .profile import corr_pairs, pearson


def variance_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """SEL-1: population variance per column and keep flag (> threshold)."""
    wide = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in cols])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("variance")) for c in cols]))
    return wide.select(arr.alias("p")).select("p.column", "p.variance", (F.col("p.variance") > threshold).alias("keep"))


def correlation_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """SEL-2: per column (position order), ``keep_ref`` = the reference's rule
    (kept when ANY earlier column has |r| <= threshold; the first column is
    never kept) and ``keep_fixed`` = dropped when any earlier |r| > threshold."""
    pairs = corr_pairs(df, cols, digits=16)
    pos = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos int")
    p = pairs.select(F.col("c2").alias("column"), F.abs("r").alias("ar"))
    agg = p.groupBy("column").agg(F.count_if(F.col("ar") <= threshold).alias("n_low"),
                                  F.count_if(F.col("ar") > threshold).alias("n_high"))
    j = pos.join(agg, "column", "left").fillna(0, subset=["n_low", "n_high"])
    return j.select("column", "pos", (F.col("n_low") > 0).alias("keep_ref"), (F.col("n_high") == 0).alias("keep_fixed"))


def gram(df: DataFrame, cols: Sequence[str], centered: bool = True) -> tuple[np.ndarray, int]:
    """k x k correlation (centered) or normalised uncentred Gram matrix from
    one aggregation over all rows.  As in the reference, infinite values become
    null and nulls the column's median; a column without any value is 0."""
    d = inf_to_null_cols(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols)
    some = d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    if holes := [c for c in cols if some[c]]:
        d = fill_by_strategy(d, holes, "median").fillna(0.0, subset=holes)
    k = len(cols)
    if centered:
        aggs = [F.corr(cols[i], cols[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i + 1, k)]
        aggs.append(F.count(F.lit(1)).alias("n"))
        row = d.agg(*aggs).first()
        m = np.eye(k)
        for i in range(k):
            for j in range(i + 1, k):
                m[i, j] = m[j, i] = row[f"g{i}_{j}"]
        return m, row["n"]
    aggs = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs.append(F.count(F.lit(1)).alias("n"))
    row = d.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"g{i}_{j}"]
    s = np.sqrt(np.diag(g))
    return g / np.outer(s, s), row["n"]


def _vif_values(m: np.ndarray) -> list[float]:
    """1 / (1 - R^2) of each column on the others, from their normalised Gram
    matrix; infinite only for columns that the others determine."""
    out = []
    for j in range(len(m)):
        rest = [i for i in range(len(m)) if i != j]
        if not rest or not np.isfinite(m[j, j]):
            out.append(1.0 if np.isfinite(m[j, j]) else math.inf)
            continue
        inner = np.nan_to_num(m[np.ix_(rest, rest)])
        cross = np.nan_to_num(m[rest, j])
        left = m[j, j] - cross @ np.linalg.pinv(inner, rcond=1e-10, hermitian=True) @ cross
        out.append(math.inf if left < 1e-9 else 1.0 / left)
    return out


def vif(df: DataFrame, cols: Sequence[str], centered: bool = True, threshold: float = 10.0,
        digits: int = 6) -> DataFrame:
    """SEL-3 (with intercept: correlation matrix) / SEL-4 (without intercept:
    normalised uncentred Gram).  A column that others determine, or that is
    constant under SEL-3, has an infinite VIF, reported as threshold + 1; the
    other columns keep their own.  The intercept itself is never scored."""
    m, _ = gram(df, cols, centered)
    rows = []
    for c, x in zip(cols, _vif_values(m)):
        x = float(x) if math.isfinite(x) else threshold + 1
        rows.append((c, round(x, digits), x > threshold if centered else x >= threshold))
    return df.sparkSession.createDataFrame(rows, "column string, vif double, flagged boolean")


def select_by_target_corr(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.1) -> DataFrame:
    """SEL-10: columns whose correlation with the target exceeds ``threshold``
    in size, strongest first; a constant column has none and is left out."""
    wide = df.agg(*[pearson(c, target).alias(f"r{i}") for i, c in enumerate(cols)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r")) for i, c in enumerate(cols)]))
    return (wide.select(each.alias("x")).select("x.*").where(F.abs("r") > threshold)
            .orderBy(F.desc(F.abs("r")), "column"))


def cramers_drop(table: DataFrame, threshold: float = 0.7) -> DataFrame:
    """SEL-6: sum of each column's V over its pairs above ``threshold``; of a
    strongly associated pair the column of greater sum is dropped (ties: the
    later name).  ``table`` has (c1, c2, v); returns (column, score, dropped)."""
    strong = table.where(F.col("v") > threshold)
    score = (strong.select(F.col("c1").alias("column"), "v").unionByName(strong.select(F.col("c2").alias("column"), "v"))
             .groupBy("column").agg(F.sum("v").alias("score")))
    one = score.select(F.col("column").alias("c1"), F.col("score").alias("s1"))
    two = score.select(F.col("column").alias("c2"), F.col("score").alias("s2"))
    worse = F.when((F.col("s1") > F.col("s2")) | ((F.col("s1") == F.col("s2")) & (F.col("c1") > F.col("c2"))), F.col("c1")).otherwise(F.col("c2"))
    gone = strong.join(one, "c1").join(two, "c2").select(worse.alias("column")).distinct().withColumn("dropped", F.lit(True))
    return score.join(gone, "column", "left").select("column", "score", F.coalesce("dropped", F.lit(False)).alias("dropped"))


def f_regression(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """SEL-7: F = r^2 / (1 - r^2) * (n - 2) per column (complete pairs)."""
    aggs = []
    for c in cols:
        ok = F.col(c).isNotNull() & F.col(target).isNotNull()
        aggs += [pearson(c, target).alias(f"r_{c}"),
                 F.count_if(ok).alias(f"n_{c}")]
    wide = df.agg(*aggs)
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r_{c}").alias("r"), F.col(f"n_{c}").alias("n"))
                              for c in cols]))
    x = wide.select(arr.alias("p")).select("p.*")
    # r = +-1 has an infinite F; a constant column (r null) has none
    left = 1 - F.col("r") ** 2
    f = F.when(left < 1e-14, F.lit(float("inf"))).otherwise(F.try_divide(F.col("r") ** 2, left) * (F.col("n") - 2))
    return x.select("column", F.when(F.col("r").isNotNull(), f).alias("f"))


def k_best(scores: DataFrame, k: int, score: str) -> DataFrame:
    """Top-k rows of a small score table (ties by column name)."""
    return scores.orderBy(F.desc(score), "column").limit(k)


def _equal_width(x, mm, bins: int):
    """Bin of ``x`` between the row ``mm``'s lo and hi; a constant or empty
    column has the one bin 0."""
    if mm["lo"] is None or mm["lo"] == mm["hi"]:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    lo, hi = F.lit(float(mm["lo"])), F.lit(float(mm["hi"]))
    return F.when(x.isNotNull(), F.least(F.floor((x - lo) / ((hi - lo) / F.lit(bins))), F.lit(bins - 1)))  # least() skips nulls


def quantile_edges(df: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner edges of quantile bins, repeated ones once, of all columns in one
    exact-quantile pass; a column without values has none."""
    probs = [i / bins for i in range(1, bins)]
    q = quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), list(cols), probs) if cols else {}
    return {c: sorted({q[(c, p)] for p in probs if q[(c, p)] is not None}) for c in cols}


def _quantile_bin(c: str, edges: list[float]):
    """Number of edges below the value: bins are closed on the right."""
    x = F.col(c).cast("double")
    return F.when(x.isNotNull(), sum((F.when(x > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0)).cast("bigint"))


def mutual_info(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10, how: str = "width") -> DataFrame:
    """SEL-8: mutual information (nats) of each feature with a class target; a
    numeric feature is cut into bins first, of equal ``width`` or by ``quantile``.

    A fixed number of jobs for any number of columns: one pass for the edges, then
    one joint count of (column, bin, class); a row counts for the columns where both
    sides are there.  A column without such rows has a null."""
    kinds = dict(df.dtypes)
    numeric = [c for c in cols if kinds[c] != "string"]
    if how == "quantile":
        edges = quantile_edges(df, numeric, bins)
        binned = {c: _quantile_bin(c, edges[c]) for c in numeric}
    else:
        ends = df.agg(F.lit(0), *[f(c).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        binned = {c: _equal_width(F.col(c), {"lo": ends[f"lo{i}"], "hi": ends[f"hi{i}"]}, bins) for i, c in enumerate(numeric)}
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), binned.get(c, F.col(c)).cast("string").alias("x")) for c in cols]))
    joint = df.where(F.col(target).isNotNull()).select(each.alias("e"), F.col(target).alias("y")).where("e.x IS NOT NULL")
    counts = cut_lineage(joint.groupBy("e.column", "e.x", "y").agg(F.count(F.lit(1)).alias("o")), "mutual_info")
    n = counts.groupBy("column").agg(F.sum("o").alias("n"))
    nx = counts.groupBy("column", "x").agg(F.sum("o").alias("nx"))
    ny = counts.groupBy("column", "y").agg(F.sum("o").alias("ny"))
    o = F.col("o").cast("double")
    mi = (counts.join(nx, ["column", "x"]).join(ny, ["column", "y"]).join(n, "column").groupBy("column")
          .agg(F.sum(o / F.col("n") * F.ln(o * F.col("n") / (F.col("nx").cast("double") * F.col("ny")))).alias("mi")))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(mi, "column", "left")


def anova_f(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """SEL-9: one-way ANOVA F of each numeric feature across target classes."""
    out = None
    for c in cols:
        d = df.where(F.col(c).isNotNull() & F.col(target).isNotNull()).select(F.col(c).cast("double").alias("x"), F.col(target).alias("g"))
        tot = d.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m")).first()
        grp = d.groupBy("g").agg(F.count(F.lit(1)).alias("ng"), F.avg("x").alias("mg"), F.var_pop("x").alias("vg"))
        j = grp.withColumn("n", F.lit(tot["n"])).withColumn("m", F.lit(tot["m"]))
        s = j.agg(F.sum(F.col("ng") * (F.col("mg") - F.col("m")) ** 2).alias("ssb"),
                  F.sum(F.col("ng") * F.col("vg")).alias("ssw"), F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
        f = s.select(F.lit(c).alias("column"),
                     F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("n") - F.col("k"))).alias("f"))
        out = f if out is None else out.unionByName(f)
    return out


def correlated_groups(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.9,
                      bins: int = 10, how: str = "width") -> DataFrame:
    """SEL-11: for each later column, the group of earlier columns with
    |r| > threshold; the best member of a group by mutual information with
    the (binned) target is kept, plus every ungrouped column."""
    pairs = corr_pairs(df, cols, digits=16).where(F.abs("r") > threshold)
    groups = pairs.select(F.col("c2").alias("key"), F.col("c1").alias("column")) \
                  .unionByName(pairs.select(F.col("c2").alias("key"), F.col("c2").alias("column"))).distinct()
    if how == "quantile":
        cut = _quantile_bin(target, quantile_edges(df, [target], bins)[target])
    else:
        cut = _equal_width(F.col(target), df.agg(F.min(target).alias("lo"), F.max(target).alias("hi")).first(), bins)
    mi = mutual_info(df.withColumn("_yb", cut), list(cols), "_yb", bins, how)
    g = groups.join(mi, "column")
    # columns that are binned alike have one score but for the order of summation
    best = g.groupBy("key").agg(F.max_by("column", F.struct(F.round("mi", 10), F.col("column"))).alias("column"))
    grouped = groups.select("column").distinct()
    ungrouped = mi.select("column").join(grouped, "column", "left_anti")
    return best.select("column").unionByName(ungrouped).distinct()


def cramers_table(df: DataFrame, pairs: Sequence[tuple[str, str]], threshold: float = 0.7,
                  corrected: bool = True, digits: int = 6, missing: str = "missing") -> DataFrame:
    """SEL-5/6 for many column pairs in one plan, no per-pair driver loop.

    One pass explodes every row into (pair, v1, v2) and counts; marginals,
    table sizes, chi-square (Yates-corrected for 2 x 2 tables, as scipy's
    default) and the bias-corrected V are then column expressions over
    small per-pair tables.  Returns (c1, c2, v, drop_c2)."""
    spark = df.sparkSession
    names = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "p int, c1 string, c2 string")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("p"),
                                         F.coalesce(F.col(a).cast("string"), F.lit(missing)).alias("v1"),
                                         F.coalesce(F.col(b).cast("string"), F.lit(missing)).alias("v2"))
                                for i, (a, b) in enumerate(pairs)]))
    ct = cut_lineage(df.select(cells.alias("x")).select("x.*").groupBy("p", "v1", "v2").agg(F.count(F.lit(1)).alias("o")))
    rm = ct.groupBy("p", "v1").agg(F.sum("o").alias("r"))
    cm = ct.groupBy("p", "v2").agg(F.sum("o").alias("c"))
    dims = ct.groupBy("p").agg(F.sum("o").alias("n"), F.countDistinct("v1").alias("nr"), F.countDistinct("v2").alias("nc"))
    plain = ct.join(rm, ["p", "v1"]).join(cm, ["p", "v2"]).groupBy("p") \
              .agg(F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("q"))
    two = dims.where((F.col("nr") == 2) & (F.col("nc") == 2)).select("p", "n")
    grid = rm.join(two, "p").join(cm, "p").join(ct, ["p", "v1", "v2"], "left").fillna(0, subset=["o"])
    e = F.col("r") * F.col("c") / F.col("n")
    dev = F.abs(F.col("o") - e)
    yates = grid.groupBy("p").agg(F.sum(F.pow(dev - F.least(F.lit(0.5), dev), 2) / e).alias("yates"))
    t = dims.join(plain, "p").join(yates, "p", "left")
    n, r, k = F.col("n").cast("double"), F.col("nr").cast("double"), F.col("nc").cast("double")
    chi2 = F.coalesce(F.col("yates"), n * (F.col("q") - 1))
    phi2 = chi2 / n
    if corrected:
        phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n - 1))
        rc, kc = r - (r - 1) * (r - 1) / (n - 1), k - (k - 1) * (k - 1) / (n - 1)
        den = F.least(kc - 1, rc - 1)
        v = F.when((r < 2) | (k < 2) | (den <= 0), F.lit(0.0)).otherwise(F.sqrt(phi2c / den))
    else:
        den = F.least(k - 1, r - 1)
        v = F.when((r < 2) | (k < 2), F.lit(0.0)).otherwise(F.sqrt(phi2 / den))
    res = t.select("p", v.alias("_v"))
    return names.join(res, "p").select("c1", "c2", F.round("_v", digits).alias("v"), (F.col("_v") > threshold).alias("drop_c2"))
