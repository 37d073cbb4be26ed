"""Wrapper feature selection with any estimator and any score (SEL-12, SEL-13, UDF-4),
and the bundle of filter and wrapper methods (SEL-14).

One interface for both plug-ins.  An estimator is anything with ``fit(train, features,
label)`` that returns a model with ``predict(df)`` (adds ``prediction``) and
``strengths()`` (feature -> weight); ``MLEstimator`` makes one of a ``pyspark.ml``
estimator, ``BoostEstimator`` of the library's boosting.  A score is an aggregate
column of label and prediction, and the direction in which it is better.

Fold table.  Rows, features without nulls and fold numbers are written once; every
(candidate, fold) fit reads it, and ``concurrency`` fits run at a time, so the cluster is
kept busy by several small jobs while the driver holds only scores."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import cut_lineage
from . import boost, select
from .model import add_folds
from .nulls import fill_by_strategy, inf_to_null_cols


@dataclass(frozen=True)
class Score:
    """``of(label, prediction)`` is an aggregate column."""

    of: Callable[[Column, Column], Column]
    greater_is_better: bool = False

    def better(self, a: float, b: float) -> bool:
        return a > b if self.greater_is_better else a < b


MAE = Score(lambda y, p: F.avg(F.abs(y - p)))
RMSE = Score(lambda y, p: F.sqrt(F.avg((y - p) * (y - p))))


@dataclass
class MLEstimator:
    """A ``pyspark.ml`` estimator (or a function that makes one): its features and
    label columns are set here.  Strengths are its feature importances, else the sizes of
    its coefficients times the features' spread."""

    estimator: object

    def fit(self, train: DataFrame, features: Sequence[str], label: str) -> "_MLModel":
        from pyspark.ml.feature import VectorAssembler
        made = self.estimator() if callable(self.estimator) and not hasattr(self.estimator, "fit") else self.estimator.copy()
        made.setFeaturesCol("_features").setLabelCol(label).setPredictionCol("prediction")
        rows = VectorAssembler(inputCols=list(features), outputCol="_features").transform(train.select(label, *features))
        return _MLModel(made.fit(rows), list(features), rows)


@dataclass
class _MLModel:
    model: object
    features: list[str]
    train: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        return self.model.transform(VectorAssembler(inputCols=self.features, outputCol="_features").transform(df)).drop("_features")

    def strengths(self) -> dict[str, float]:
        if hasattr(self.model, "featureImportances"):
            return dict(zip(self.features, (float(v) for v in self.model.featureImportances.toArray())))
        spread = self.train.agg(*[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(self.features)]).first()
        return {f: abs(float(c)) * (spread[f"s{i}"] or 0.0) for i, (f, c) in enumerate(zip(self.features, self.model.coefficients))}


@dataclass
class BoostEstimator:
    settings: boost.Settings = field(default_factory=boost.Settings)
    key: str = "_key"

    def fit(self, train: DataFrame, features: Sequence[str], label: str) -> "_BoostModel":
        return _BoostModel(boost.fit(train, features, label, self.key, self.settings))


@dataclass
class _BoostModel:
    booster: boost.Booster

    def predict(self, df: DataFrame) -> DataFrame:
        return self.booster.predict(df)

    def strengths(self) -> dict[str, float]:
        return dict(self.booster.importances())


def fold_table(df: DataFrame, features: Sequence[str], label: str, folds: int = 3, key: str = "row_id") -> DataFrame:
    """(_key, label, fold, features) of the rows that have a label, written once.  As in
    the reference nulls are filled first: infinite values become null, nulls the mean
    of their feature, a feature without any value 0."""
    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.col(label).cast("double").alias(label), *[F.col(f).cast("double").alias(f) for f in features])
    rows = inf_to_null_cols(rows, [*features, label]).dropna(subset=[label])
    rows = fill_by_strategy(rows, list(features), "mean").fillna(0.0, subset=list(features))
    return cut_lineage(add_folds(rows, folds, "_key"), "fold_table")


def _run(spark, jobs: list[Callable], concurrency: int) -> list:
    """The results of the jobs, in order, ``concurrency`` of them at a time."""
    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def _mean_std(values: Sequence[float]) -> tuple[float, float]:
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def folds_of(table: DataFrame) -> list[int]:
    return sorted(r[0] for r in table.select("fold").distinct().collect())  # k rows


def fold_score(table: DataFrame, features: Sequence[str], label: str, fold: int, estimator, score: Score):
    """(score on the fold, the model fitted on the others)."""
    model = estimator.fit(table.where(F.col("fold") != fold), features, label)
    value = model.predict(table.where(F.col("fold") == fold)).agg(score.of(F.col(label), F.col("prediction"))).first()[0]
    if value is None or not math.isfinite(value):
        raise ValueError(f"no finite score of {list(features)} on fold {fold}")
    return float(value), model


def cross_validate(df: DataFrame, features: Sequence[str], label: str, estimator, scores: dict[str, Score], folds: int = 5,
                   key: str = "row_id", concurrency: int = 4) -> DataFrame:
    """EVA-2 with a caller's estimator and scores: (fold, one column a score)."""
    table = fold_table(df, features, label, folds, key)

    def one(f: int):
        model = estimator.fit(table.where(F.col("fold") != f), features, label)
        row = model.predict(table.where(F.col("fold") == f)).agg(*[s.of(F.col(label), F.col("prediction")).cast("double").alias(n) for n, s in scores.items()]).first()
        return (f, *row)

    rows = _run(df.sparkSession, [lambda f=f: one(f) for f in folds_of(table)], concurrency)
    return df.sparkSession.createDataFrame(rows, ", ".join(["fold int", *(f"`{n}` double" for n in scores)]))


@dataclass
class Selection:
    """``sizes``: (number of features, mean, std, features of that size); ``chosen``: those of the best size."""

    sizes: list[tuple[int, float, float, list[str]]]
    chosen: list[str]

    def table(self, spark) -> DataFrame:
        rows = [(n, m, s, ",".join(f), set(f) == set(self.chosen)) for n, m, s, f in self.sizes]
        return spark.createDataFrame(rows, "n_features int, mean double, std double, features string, best boolean")


def forward_selection(df: DataFrame, features: Sequence[str], label: str, estimator, score: Score = MAE, folds: int = 3,
                      key: str = "row_id", concurrency: int = 4, table: DataFrame | None = None) -> Selection:
    """SEL-13: at each size the feature that helps most is added, by the mean score
    over the folds (ties to the earlier feature); the size of best mean is chosen
    (ties to the smaller).  ``table``: the fold table of ``df``, if there is one already."""
    if not features:
        raise ValueError("no features to choose from")
    table, chosen, sizes = table or fold_table(df, features, label, folds, key), [], []
    numbers = folds_of(table)
    while len(chosen) < len(features):
        rest = [f for f in features if f not in chosen]
        got = _run(df.sparkSession, [lambda c=c, f=f: fold_score(table, [*chosen, c], label, f, estimator, score)[0] for c in rest for f in numbers], concurrency)
        best = None
        for i, c in enumerate(rest):
            mean, std = _mean_std(got[i * len(numbers):(i + 1) * len(numbers)])
            if best is None or score.better(mean, best[1]):
                best = c, mean, std
        chosen = [*chosen, best[0]]
        sizes.append((len(chosen), best[1], best[2], chosen))
    top = sizes[0]
    for s in sizes[1:]:
        top = s if score.better(s[1], top[1]) else top
    return Selection(sizes, top[3])


def _weakest(strengths: dict[str, float], features: list[str], n: int) -> list[str]:
    return sorted(features, key=lambda f: strengths[f])[:n]  # stable: ties go in the order of the features


def recursive_elimination(df: DataFrame, features: Sequence[str], label: str, estimator, score: Score = MAE, folds: int = 3,
                          key: str = "row_id", step: int | None = None, concurrency: int = 4, table: DataFrame | None = None) -> Selection:
    """SEL-12: in every fold the ``step`` weakest features (a tenth of all, one at
    least) are dropped again and again, each size scored on the fold; the size of best
    mean is chosen (ties to the smaller), and its features by dropping on all rows.
    ``table``: the fold table of ``df``, if there is one already."""
    features = list(features)
    step = step or max(1, len(features) // 10)
    table = table or fold_table(df, features, label, folds, key)

    def one(fold: int) -> list[float]:
        left, out = features, []
        while True:
            value, model = fold_score(table, left, label, fold, estimator, score)
            out.append(value)
            if len(left) == 1:
                return out
            gone = _weakest(model.strengths(), left, min(step, len(left) - 1))
            left = [f for f in left if f not in gone]

    numbers = folds_of(table)
    by_fold = _run(df.sparkSession, [lambda f=f: one(f) for f in numbers], concurrency)
    left, order = features, [features]
    while len(left) > 1:
        gone = _weakest(estimator.fit(table, left, label).strengths(), left, min(step, len(left) - 1))
        left = [f for f in left if f not in gone]
        order.append(left)
    sizes = [(len(own), *_mean_std([b[i] for b in by_fold]), own) for i, own in enumerate(order)]
    top = sizes[-1]
    for s in reversed(sizes[:-1]):
        top = s if score.better(s[1], top[1]) else top
    return Selection(sizes, top[3])


def select_k_best(df: DataFrame, cols: Sequence[str], target: str, score_func: Callable[..., DataFrame], k: int = 20) -> DataFrame:
    """UDF-4: the ``k`` columns of greatest score, where ``score_func(df, cols, target)``
    returns (column, score), e.g. ``select.f_regression``; a score that is null or not a number counts as none."""
    got = score_func(df, list(cols), target)
    return got.toDF("column", "score").where("score IS NOT NULL AND NOT isnan(score)").orderBy(F.desc("score"), "column").limit(k)


# ---------------------------------------------------------------------------
# SEL-14: filter and wrapper methods side by side
# ---------------------------------------------------------------------------

def compared(spark, name: str, one: Sequence[str], two: Sequence[str], original: Sequence[str]) -> list[tuple[str, str, str]]:
    """Rows (method, set, feature) of what two methods have in common, together, and leave."""
    a, b = set(one), set(two)
    sets = {"common": a & b, "union": a | b, "rest": set(original) - (a | b)}
    return [(name, s, f) for s, own in sets.items() for f in original if f in own]


def filter_sets(df: DataFrame, numeric: Sequence[str], variance: float = 0.1, correlation: float = 0.8) -> list[tuple[str, str, str]]:
    """The variance and correlation filters and their sets."""
    spark = df.sparkSession
    var = [r["column"] for r in select.variance_filter(df, numeric, variance).where("keep").collect()]  # one row a column
    corr = [r["column"] for r in select.correlation_filter(df, numeric, correlation).where("keep_ref").collect()]
    own = [("variance", "selected", f) for f in numeric if f in var] + [("correlation", "selected", f) for f in numeric if f in corr]
    return own + compared(spark, "filter", var, corr, numeric)


def selection_bundle(df: DataFrame, numeric: Sequence[str], text: Sequence[str], label: str, estimator, score: Score = MAE, key: str = "row_id",
                     k: int = 20, class_label: str | None = None, vif_threshold: float = 10.0, cramers_threshold: float = 0.7,
                     folds: int = 3, concurrency: int = 4) -> DataFrame:
    """SEL-14: a long table (method, set, feature) of VIF, Cramér's V, the filters,
    the k best numeric features (F test) and, with a ``class_label``, text features
    (mutual information), and both wrapper methods over the numeric features.  The rows
    are written once for all filters, the fold table once for both wrappers."""
    spark, numeric, text = df.sparkSession, list(numeric), list(text)
    df = cut_lineage(df.select(*dict.fromkeys([key, label, *numeric, *text, *([class_label] if class_label else [])])), "bundle_rows")
    rows = [("vif", "flagged", r["column"]) for r in select.vif(df, numeric, threshold=vif_threshold).where("flagged").collect()]
    pairs = [(a, b) for i, a in enumerate(text) for b in text[i + 1:]]
    if pairs:
        strong = select.cramers_drop(select.cramers_table(df, pairs, cramers_threshold), cramers_threshold)
        rows += [("cramers_v", "dropped", r["column"]) for r in strong.where("dropped").collect()]
    rows += filter_sets(df, numeric)
    rows += [("k_best", "numeric", r["column"]) for r in select_k_best(df, numeric, label, select.f_regression, k).collect()]
    if text and class_label:
        rows += [("k_best", "text", r["column"]) for r in select_k_best(df, text, class_label, select.mutual_info, k).collect()]
    table = fold_table(df, numeric, label, folds, key)
    rfe = recursive_elimination(df, numeric, label, estimator, score, folds, key, concurrency=concurrency, table=table).chosen
    sfs = forward_selection(df, numeric, label, estimator, score, folds, key, concurrency=concurrency, table=table).chosen
    rows += [("rfe", "selected", f) for f in rfe] + [("sfs", "selected", f) for f in sfs]
    rows += compared(spark, "wrapper", rfe, sfs, numeric)
    return spark.createDataFrame(rows, "method string, set string, feature string")
