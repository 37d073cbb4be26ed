"""Wrapper selection, the selection bundle, regularised boosting and caller's scores
(2.15, 2.16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boost, model, nulls, wrapper
from ..session import scratch_path
from ..sources import files, views
from .q_model import _FOLD, FEATS, _model_table
from .registry import query
from .sqltext import with_views

WRAPPED = ["area", "bal", "built_year", "contract_day", "lat"]


def forest():
    from pyspark.ml.regression import RandomForestRegressor
    return RandomForestRegressor(numTrees=5, maxDepth=4, seed=1)


def least_squares():
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(solver="normal")


def _train(spark, sf):
    return views.trades(spark, sf).where("is_test = 0").select("row_id", "target", *WRAPPED, "lon", "heating", "deal_type", "district", "hood")


@query("sel_wrapper_forward", ("SEL-13", "UDF-4"))
def q_forward(spark, sf):
    return wrapper.forward_selection(_train(spark, sf), WRAPPED[:4], "target", wrapper.MLEstimator(forest)).table(spark)


@query("sel_wrapper_elimination", ("SEL-12", "UDF-4"))
def q_elimination(spark, sf):
    return wrapper.recursive_elimination(_train(spark, sf), WRAPPED, "target", wrapper.MLEstimator(forest)).table(spark)


FILTERED = ["lat", "area", "target", "bal", "built_year", "contract_day", "lon", "mostly_null"]


def _filter_sql():
    var = " UNION ALL ".join(f"SELECT '{c}' AS f, {i} AS pos, var_pop(CAST({c} AS DOUBLE)) > 0.1 AS kept FROM trades" for i, c in enumerate(FILTERED))
    pairs = " UNION ALL ".join(f"SELECT '{b}' AS f, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) AS ar FROM trades"
                               for i, a in enumerate(FILTERED) for b in FILTERED[i + 1:])
    return with_views(f"""
, v AS (SELECT f FROM ({var}) WHERE kept), c AS (SELECT DISTINCT f FROM ({pairs}) WHERE ar <= 0.8),
u AS (SELECT f FROM v UNION SELECT f FROM c)
SELECT 'variance' AS method, 'selected' AS "set", f AS feature FROM v
UNION ALL SELECT 'correlation', 'selected', f FROM c
UNION ALL SELECT 'filter', 'common', f FROM (SELECT f FROM v INTERSECT SELECT f FROM c)
UNION ALL SELECT 'filter', 'union', f FROM u
UNION ALL SELECT 'filter', 'rest', f FROM (SELECT unnest({FILTERED!r}) AS f) WHERE f NOT IN (SELECT f FROM u)
""", "trades")


@query("sel_filter_sets_json", ("SEL-14", "SNK-3", "SET-3"), _filter_sql())
def q_filter_sets(spark, sf):
    rows = wrapper.filter_sets(views.trades(spark, sf), FILTERED)
    sets = spark.createDataFrame(rows, "method string, set string, feature string")
    return files.read_selection(spark, files.write_selection(sets, scratch_path(spark, "selection")))


@query("sel_bundle", ("SEL-14", "SNK-3", "UDF-4"))
def q_bundle(spark, sf):
    got = wrapper.selection_bundle(_train(spark, sf), WRAPPED, ["heating", "deal_type", "district"], "target",
                                   wrapper.MLEstimator(least_squares), k=3, class_label="hood")
    return files.read_selection(spark, files.write_selection(got, scratch_path(spark, "bundle")))


@query("mdl_regularised_boosting", ("MDL-2", "EVA-1", "EVA-4"))
def q_boost(spark, sf):
    train, _ = _model_table(spark, sf)
    fit, valid = model.holdout_split(train, 0.2)
    settings = boost.Settings(rounds=6, depth=4, rate=0.3, l1=1.12406, l2=5.081, gamma=2.46691, subsample=0.6239, colsample=0.63995)
    booster = boost.fit(fit, [*FEATS, "district"], settings=settings)
    return model.rmse_by(booster.predict(valid), "target", "prediction").withColumn("top_feature", F.lit(booster.importances()[0][0]))


@query("eva_custom_scores", ("UDF-4", "EVA-2"), with_views(f"""
, d AS (SELECT coalesce(area, (SELECT avg(area) FROM trades WHERE is_test = 0)) + bal / 500e0 AS x, target AS y, {_FOLD} AS fold FROM trades WHERE is_test = 0),
f AS (SELECT g.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM d, (SELECT DISTINCT fold FROM d) g WHERE d.fold <> g.fold GROUP BY 1)
SELECT CAST(d.fold AS INTEGER) AS fold, round(avg(abs(y - a * x - b)), 3) AS mae, round(max(abs(y - a * x - b)), 3) AS worst,
       round(avg(CASE WHEN abs(y - a * x - b) <= 0.1 * y THEN 1e0 ELSE 0e0 END), 6) AS within_tenth
FROM d JOIN f ON d.fold = f.fold GROUP BY 1
""", "trades"))
def q_custom_scores(spark, sf):
    t = nulls.fill_by_strategy(views.trades(spark, sf).where("is_test = 0"), ["area"], "mean") \
             .select("row_id", "target", (F.col("area") + F.col("bal") / F.lit(500.0)).alias("mix"))
    scores = {"mae": wrapper.MAE, "worst": wrapper.Score(lambda y, p: F.max(F.abs(y - p))),
              "within_tenth": wrapper.Score(lambda y, p: F.avg((F.abs(y - p) <= y * 0.1).cast("double")), True)}
    got = wrapper.cross_validate(t, ["mix"], "target", wrapper.MLEstimator(least_squares), scores)
    return got.select("fold", F.round("mae", 3).alias("mae"), F.round("worst", 3).alias("worst"), F.round("within_tenth", 6).alias("within_tenth"))
