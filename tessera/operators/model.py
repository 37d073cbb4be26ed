"""Splits, models, evaluation and scoring (SPL-*, MDL-*, EVA-*, INF-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import cut_lineage


def rmse_by(df: DataFrame, y: str, p: str, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """EVA-1: RMSE (optionally per group), with the row count."""
    err = (F.col(y) - F.col(p)) * (F.col(y) - F.col(p))
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err)), digits).alias("rmse")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# ---------------------------------------------------------------------------
# Splits (SPL-1, SPL-2): hashed row keys, stable under repartitioning
# ---------------------------------------------------------------------------

from ..functions.scalar import fold_of, is_holdout  # noqa: E402


def add_folds(df: DataFrame, k: int = 5, key: str = "row_id", seed: int = 0, name: str = "fold") -> DataFrame:
    """SPL-2: fold number in [0, k) from the hashed row key."""
    return df.withColumn(name, fold_of(key, k, seed).cast("int"))


def holdout_split(df: DataFrame, test_ratio: float = 0.2, key: str = "row_id", seed: int = 0):
    """SPL-1: (train, validation) by hashed key."""
    h = is_holdout(key, test_ratio, seed)
    return df.where(~h), df.where(h)


def mae(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVA-3: mean absolute error."""
    return df.agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"))


def kfold_group_mean(df: DataFrame, key: str, y: str, fold: str = "fold", digits: int = 4,
                     log_target: bool = False) -> DataFrame:
    """EVA-2 with a group-mean predictor: every fold is predicted by group
    means of the other folds, from ONE aggregation by (group, fold): the
    out-of-fold mean is (S_g - S_gf) / (N_g - N_gf).  Unseen groups fall back
    to the out-of-fold global mean.  With ``log_target`` the model is fitted
    on ln(y) and predictions and truth are both exponentiated back (Q10)."""
    yy = F.ln(F.col(y)) if log_target else F.col(y)
    d = df.select(key, fold, y, yy.alias("_y"))
    gf = d.groupBy(key, fold).agg(F.sum("_y").alias("s_gf"), F.count(F.lit(1)).alias("n_gf"))
    g = gf.groupBy(key).agg(F.sum("s_gf").alias("s_g"), F.sum("n_gf").alias("n_g"))
    per_fold = [(r[0], r[1], r[2]) for r in gf.groupBy(fold).agg(F.sum("s_gf"), F.sum("n_gf")).collect()]  # k rows
    s_all, n_all = sum(r[1] for r in per_fold), sum(r[2] for r in per_fold)
    glob = df.sparkSession.createDataFrame(
        [(int(f_), (s_all - s_f) / (n_all - n_f)) for f_, s_f, n_f in per_fold], f"{fold} int, _gm double")
    oof = gf.join(g, key).where(F.col("n_g") > F.col("n_gf")) \
            .select(key, fold, ((F.col("s_g") - F.col("s_gf")) / (F.col("n_g") - F.col("n_gf"))).alias("_m"))
    pred = d.join(oof, [key, fold], "left").join(F.broadcast(glob), d[fold].cast("int") == glob[fold]).drop(glob[fold]) \
            .withColumn("_p", F.coalesce("_m", "_gm"))
    if log_target:
        pred = pred.withColumn("_p", F.exp("_p"))
    err = F.col(y) - F.col("_p")
    return pred.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err * err)), digits).alias("rmse"),
                                  F.round(F.avg(F.abs(err)), digits).alias("mae"))


# ---------------------------------------------------------------------------
# Models (MDL-*), importance (EVA-4, EVA-5), scoring (INF-1)
# ---------------------------------------------------------------------------

def assemble(df: DataFrame, features, out: str = "features"):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def make_regressor(kind: str = "rf", **p):
    """MDL-1/2/3: random forest, gradient boosting (parameters of the three
    boosting libraries mapped to GBTRegressor: depth, learning rate, rounds,
    row / column subsampling; L1/L2/gamma have no equal and are ignored),
    or linear / ridge regression."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    if kind == "rf":
        return RandomForestRegressor(numTrees=p.get("n_estimators", 5), maxDepth=p.get("max_depth", 5),
                                     maxBins=p.get("max_bins", 64), seed=p.get("seed", 1), labelCol=p.get("label", "target"))
    if kind == "gbt":
        return GBTRegressor(maxDepth=p.get("max_depth", 5), stepSize=p.get("learning_rate", 0.1),
                            maxIter=p.get("n_estimators", 20), subsamplingRate=p.get("subsample", 1.0),
                            featureSubsetStrategy=str(p.get("colsample", "all")), maxBins=p.get("max_bins", 64),
                            seed=p.get("seed", 1), labelCol=p.get("label", "target"))
    if kind in ("linear", "ridge"):
        return LinearRegression(regParam=p.get("alpha", 0.0 if kind == "linear" else 1.0), elasticNetParam=0.0,
                                solver="normal", labelCol=p.get("label", "target"))
    raise ValueError(kind)


def fit_predict(train: DataFrame, test: DataFrame, features, kind: str = "rf", label: str = "target", **p):
    """Fit on train, predict test; returns (model, predictions)."""
    est = make_regressor(kind, label=label, **p)
    model = est.fit(assemble(train, features))
    return model, model.transform(assemble(test, features))


def cross_validate(df: DataFrame, features, kind: str = "rf", label: str = "target", fold: str = "fold", digits: int = 4, **p) -> DataFrame:
    """EVA-2: a model fitted for each fold on the other folds; (fold, n, rmse,
    mae) on the fold itself.  The rows are written once; every fit and score reads them."""
    df = cut_lineage(df.select(*dict.fromkeys([fold, label, *features])), "cv_folds")
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())  # k rows
    out = None
    for f in folds:
        _, pred = fit_predict(df.where(F.col(fold) != f), df.where(F.col(fold) == f), features, kind, label, **p)
        err = F.col(label) - F.col("prediction")
        one = pred.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err * err)), digits).alias("rmse"),
                                     F.round(F.avg(F.abs(err)), digits).alias("mae"))
        out = one if out is None else out.unionByName(one)
    return out


def importances(model, features) -> list[tuple[str, float]]:
    """EVA-4 / SRT-2: tree feature importances, sorted descending (k rows)."""
    imp = model.featureImportances.toArray()
    return sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda t: (-t[1], t[0]))


def permutation_importance(model, df: DataFrame, features, label: str = "target", key: str = "row_id",
                           repeats: int = 3, seed: int = 7) -> DataFrame:
    """EVA-5: drop in negative MSE when one column is permuted.  A repeat pairs each
    row's rank under a seeded hash with the row at the same rank under the row order: one
    join on a dense position a repeat, no driver shuffle; the donor's values then take
    the place of one column at a time, all variants of a row in one pass."""
    from .ordering import with_position
    base = model.transform(assemble(df, features)).agg(F.avg((F.col(label) - F.col("prediction")) ** 2)).first()[0]
    donors = (df.join(with_position(df.select(key), key, "_p"), key)
              .select(F.col("_p").alias("_q"), F.struct(*[F.col(f) for f in features]).alias("_d")))
    variant = lambda f: F.struct(F.lit(f).alias("feature"), *[F.col(f"_d.{g}" if g == f else g).alias(g) for g in features])
    allv = None
    for r in range(repeats):
        perm = with_position(df.select(key, F.xxhash64(F.col(key), F.lit(seed + r)).alias("_h")), "_h", "_q").select(key, "_q")
        one = (df.join(perm, key).join(donors, "_q")
               .select(F.lit(r).alias("rep"), F.col(label), F.explode(F.array(*[variant(f) for f in features])).alias("_v"))
               .select("rep", label, "_v.*"))
        allv = one if allv is None else allv.unionByName(one)
    scored = model.transform(assemble(allv, features))
    mse = scored.groupBy("feature", "rep").agg(F.avg((F.col(label) - F.col("prediction")) ** 2).alias("mse"))
    return mse.groupBy("feature").agg((F.avg("mse") - F.lit(base)).alias("importance"),
                                      F.stddev_pop("mse").alias("std")).orderBy(F.desc("importance"))


def score(model, df: DataFrame, train_cols, key: str = "row_id", out: str = "target") -> DataFrame:
    """INF-1: align to the model's columns, predict, truncate to integer."""
    from .schema import align_to
    x = align_to(df, [key, *train_cols])
    return model.transform(assemble(x, train_cols)).select(key, F.col("prediction").cast("bigint").alias(out))


# ---------------------------------------------------------------------------
# Wrapper selection on Gram sums (SEL-12, SEL-13): one aggregation by fold,
# every candidate model solved on the driver from k x k matrices.
# ---------------------------------------------------------------------------

def fold_gram(df: DataFrame, features, label: str, fold: str = "fold"):
    """Gram sums of every row that has a label, by fold.  As in the reference,
    nulls (and infinite values) of a feature are filled with its mean first; a
    feature without any value is 0."""
    import numpy as np

    from .nulls import fill_by_strategy, inf_to_null_cols
    cols = ["_one", *features]
    d = df.select(F.lit(1.0).alias("_one"), *[F.col(c).cast("double").alias(c) for c in features],
                  F.col(label).cast("double").alias("_y"), fold)
    d = inf_to_null_cols(d, [*features, "_y"]).dropna(subset=["_y"])
    d = fill_by_strategy(d, features, "mean").fillna(0.0, subset=list(features))
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    aggs += [F.sum(F.col(a) * F.col("_y")).alias(f"{i}_y") for i, a in enumerate(cols)]
    aggs += [F.sum(F.col("_y") * F.col("_y")).alias("yy")]
    rows = d.groupBy(fold).agg(*aggs).collect()
    k = len(cols)
    out = {}
    for r in rows:
        g = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                g[i, j] = g[j, i] = r[f"{i}_{j}"]
        out[r[fold]] = (g, np.array([r[f"{i}_y"] for i in range(k)]), r["yy"])
    return out


def cv_rmse_subset(grams, subset_idx) -> tuple[float, float]:
    """Mean and population std over folds of validation RMSE for OLS on a subset."""
    import numpy as np
    idx = [0, *[i + 1 for i in subset_idx]]
    scores = []
    for f in grams:
        g_tr = sum(grams[o][0] for o in grams if o != f)
        b_tr = sum(grams[o][1] for o in grams if o != f)
        beta = np.linalg.lstsq(g_tr[np.ix_(idx, idx)], b_tr[idx], rcond=None)[0]
        gv, bv, yy = grams[f]
        n = gv[0, 0]
        sse = yy - 2 * beta @ bv[idx] + beta @ gv[np.ix_(idx, idx)] @ beta
        scores.append(float(np.sqrt(max(sse, 0.0) / n)))
    return float(np.mean(scores)), float(np.std(scores))


def forward_selection(df: DataFrame, features, label: str, folds: int = 3, key: str = "row_id") -> list[tuple]:
    """SEL-13: greedy forward selection with k-fold CV; rows (k, added, mean, std)."""
    grams = fold_gram(add_folds(df, folds, key), features, label)
    chosen, rows = [], []
    while len(chosen) < len(features):
        best = None
        for i in range(len(features)):
            if i in chosen:
                continue
            m, s = cv_rmse_subset(grams, [*chosen, i])
            if best is None or m < best[1]:
                best = (i, m, s)
        chosen.append(best[0])
        rows.append((len(chosen), features[best[0]], best[1], best[2]))
    return rows


def recursive_elimination(df: DataFrame, features, label: str, folds: int = 3, key: str = "row_id") -> list[tuple]:
    """SEL-12: drop max(1, n // 10) weakest features per step (weakest =
    smallest |standardised OLS coefficient| on all rows), scoring each subset
    by k-fold CV RMSE; rows (n_features, dropped, mean, std)."""
    import numpy as np
    grams = fold_gram(add_folds(df, folds, key), features, label)
    g = sum(v[0] for v in grams.values())
    b = sum(v[1] for v in grams.values())
    n = g[0, 0]
    means = g[0, 1:] / n
    stds = np.sqrt(np.maximum(np.diag(g)[1:] / n - means ** 2, 1e-300))
    left = list(range(len(features)))
    rows = [(len(left), None, *cv_rmse_subset(grams, left))]
    while len(left) > 1:
        idx = [0, *[i + 1 for i in left]]
        beta = np.linalg.lstsq(g[np.ix_(idx, idx)], b[idx], rcond=None)[0][1:]
        strength = np.abs(beta) * stds[left]
        step = max(1, len(left) // 10)
        drop = [left[i] for i in np.argsort(strength, kind="stable")[:step]]
        left = [i for i in left if i not in drop]
        rows.append((len(left), ",".join(features[i] for i in drop), *cv_rmse_subset(grams, left)))
    return rows
