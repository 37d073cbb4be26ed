"""Clustering (2.14), splits / models / evaluation / scoring (2.16) and runs (2.17)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.scalar import hash_multiplier
from ..operators import cluster, combine, encode, model, nulls, runs
from ..session import scratch_path
from ..sources import files, views
from ..sources.tables import table
from .registry import query
from .sqltext import with_views

EPS, MIN_SAMPLES = 0.2, 5

_Z = """, st AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy FROM cluster_points),
z AS (SELECT point_id, (x - mx) / sx AS x, (y - my) / sy AS y FROM cluster_points, st)"""


def _dbscan_sql():
    body = with_views(_Z + f""",
nb AS (SELECT a.point_id AS a, b.point_id AS b FROM z a JOIN z b
       ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}e0 * {EPS}e0),
core AS (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
ce AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON nb.a = c1.id JOIN core c2 ON nb.b = c2.id),
reach AS (SELECT a, b FROM ce UNION SELECT r.a, ce.b FROM reach r JOIN ce ON r.b = ce.a),
comp AS (SELECT a AS id, min(b) AS label FROM reach GROUP BY a),
border AS (SELECT nb.a AS id, min(comp.label) AS label FROM nb JOIN comp ON nb.b = comp.id
           WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a),
lab AS (SELECT * FROM comp UNION ALL SELECT * FROM border),
codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM lab)),
out AS (SELECT p.point_id, coalesce(codes.cluster, -1) AS label FROM cluster_points p
        LEFT JOIN lab ON p.point_id = lab.id LEFT JOIN codes ON lab.label = codes.label)
SELECT point_id, label, count(*) OVER (PARTITION BY label) AS cluster_size FROM out
""", "cluster_points")
    return "WITH RECURSIVE" + body[len("WITH"):]


@query("clu_dbscan", "CLU-2", _dbscan_sql())
def q_dbscan(spark, sf):
    pts = cluster.standardize(views.cluster_points(spark, sf), ["x", "y"])
    return cluster.dbscan(pts, EPS, MIN_SAMPLES)


@query("clu_k_distance", "CLU-3", with_views(_Z + """,
d AS (SELECT a.point_id AS a, b.point_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM z a, z b)
SELECT a AS point_id, round(d, 8) AS kdist FROM (
  SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM d) WHERE rn = 5
""", "cluster_points"))
def q_kdist(spark, sf):
    pts = cluster.standardize(views.cluster_points(spark, sf), ["x", "y"])
    return cluster.k_distance(pts, 5).select("point_id", F.round("kdist", 8).alias("kdist"))


@query("clu_kmeans_features", ("CLU-1", "AGG-10"))
def q_kmeans(spark, sf):
    pts = views.cluster_points(spark, sf)
    km = cluster.kmeans_features(pts, ["x", "y"], k=5, seed=42, prefix="cluster_select")
    db = cluster.dbscan(cluster.standardize(pts, ["x", "y"]), EPS, MIN_SAMPLES) \
                .select("point_id", F.col("label").alias("cluster_dbscan"), F.col("cluster_size").alias("cluster_dbscan_count"))
    feats = km.join(db, "point_id")
    stats = feats.join(pts, "point_id").groupBy("cluster_select").agg(
        F.round(F.avg("x"), 2).alias("x_mean"), F.round(F.stddev_samp("x"), 2).alias("x_std"))
    return feats.join(stats, "cluster_select")


_FOLD = "((((row_id % 2147483648) * 2654435761) % 4294967296) % 4294967296) % 5"
_HOLD = "((((row_id % 2147483648) * 2654435761) % 4294967296) % 4294967296) % 1000 < 200"


@query("spl_folds_holdout", ("SPL-1", "SPL-2"), with_views(f"""
SELECT row_id, CAST({_FOLD} AS INTEGER) AS fold, {_HOLD} AS holdout FROM trades
""", "trades"))
def q_folds(spark, sf):
    t = model.add_folds(views.trades(spark, sf).select("row_id"), 5)
    return t.withColumn("holdout", model.is_holdout("row_id", 0.2))


_SEEDED = ", ".join(f"((row_id % 2147483648) * {hash_multiplier(s)}) % 4294967296 % 1000 < 200 AS holdout_{s}" for s in (2023, 2024))


@query("spl_seeded_holdouts", ("SPL-1", "SPL-2"), with_views(f"""
SELECT row_id, {_SEEDED}, CAST(((row_id % 2147483648) * {hash_multiplier(2023)}) % 4294967296 % 5 AS INTEGER) AS fold FROM trades
""", "trades"))
def q_seeded(spark, sf):
    t = views.trades(spark, sf).select("row_id")
    for seed in (2023, 2024):
        t = t.withColumn(f"holdout_{seed}", model.is_holdout("row_id", 0.2, seed))
    return model.add_folds(t, 5, seed=2023)


@query("smp_bootstrap_exact", "SMP-1", with_views("""
SELECT 3 * count(*) AS n, 0 AS strangers FROM trades
""", "trades"))
def q_bootstrap_exact(spark, sf):
    """Three times as many draws as rows: the size is exact and every draw is a row."""
    t = views.trades(spark, sf).select("row_id")
    drawn = combine.bootstrap_exact(t, 3 * t.count())
    known = drawn.join(t.withColumnRenamed("row_id", "_known"), F.col("row_id") == F.col("_known"), "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_known").isNull()).cast("int").alias("strangers"))


@query("eva_kfold_group_mean", ("EVA-2", "EVA-3", "EVA-6"), with_views(f"""
, d AS (SELECT row_id, district, target, CAST({_FOLD} AS INTEGER) AS fold FROM trades),
oof AS (SELECT t1.row_id, avg(t2.target) AS m FROM d t1 JOIN d t2 ON t1.district = t2.district AND t2.fold <> t1.fold
        GROUP BY t1.row_id),
gm AS (SELECT f.fold, avg(d.target) AS g FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
p AS (SELECT d.fold, d.target, coalesce(oof.m, gm.g) AS pred FROM d LEFT JOIN oof ON d.row_id = oof.row_id JOIN gm ON d.fold = gm.fold)
SELECT fold, count(*) AS n, round(sqrt(avg((target - pred) * (target - pred))), 4) AS rmse,
       round(avg(abs(target - pred)), 4) AS mae
FROM p GROUP BY fold
""", "trades"))
def q_kfold(spark, sf):
    t = model.add_folds(views.trades(spark, sf).select("row_id", "district", "target"), 5)
    return model.kfold_group_mean(t, "district", "target")


@query("mdl_linear_one_feature", "MDL-3", with_views("""
SELECT round(regr_slope(target, area), 6) AS slope, round(regr_intercept(target, area), 4) AS intercept
FROM (SELECT target, coalesce(area, (SELECT avg(area) FROM trades WHERE is_test = 0)) AS area, bal FROM trades WHERE is_test = 0)
""", "trades").replace("regr_slope(target, area)", "regr_slope(target, area + bal / 500e0)").replace(
    "regr_intercept(target, area)", "regr_intercept(target, area + bal / 500e0)"))
def q_linear(spark, sf):
    t = nulls.fill_by_strategy(views.trades(spark, sf).where("is_test = 0"), ["area"], "mean") \
             .withColumn("mix", F.col("area") + F.col("bal") / F.lit(500.0))
    m = model.make_regressor("linear", label="target").fit(model.assemble(t, ["mix"]))
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 4))],
                                 "slope double, intercept double")


FEATS = ["area", "bal", "built_year", "contract_day", "lon", "lat"]


def _model_table(spark, sf):
    t = views.trades(spark, sf).select("row_id", "is_test", "district", "target", *FEATS)
    t = t.fillna(0.0, subset=["area", "lon", "lat"]).withColumn("built_year", F.coalesce("built_year", F.lit(2000)))
    tr, te = t.where("is_test = 0"), t.where("is_test = 1")
    tr, te = encode.target_encode(tr, te, ["district"], "target")
    return tr, te


@query("mdl_random_forest_scoring", ("MDL-1", "INF-1", "SNK-4", "PRJ-10", "EVA-4"))
def q_rf(spark, sf):
    tr, te = _model_table(spark, sf)
    cols = [*FEATS, "district"]
    m, _ = model.fit_predict(tr, te, cols, "rf", n_estimators=5)
    from pyspark.ml import PipelineModel
    path = scratch_path(spark, "rf_model")
    files.save_model(PipelineModel(stages=[m]), path)
    loaded = files.load_model(path)
    scored = model.score(loaded, te.withColumn("extra_col", F.lit(1)), cols)
    top = model.importances(m, cols)[0][0]
    return scored.withColumn("top_feature", F.lit(top))


@query("mdl_gbt_holdout", ("MDL-2", "EVA-1"))
def q_gbt(spark, sf):
    tr, _ = _model_table(spark, sf)
    fit, val = model.holdout_split(tr, 0.2)
    m, pred = model.fit_predict(fit, val, [*FEATS, "district"], "gbt", n_estimators=10, max_depth=4,
                                learning_rate=0.1, subsample=0.8)
    return model.rmse_by(pred, "target", "prediction")


@query("mdl_pipeline_classifier", "MDL-4")
def q_pipeline(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source") \
        .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    few = len(d.select("quality").distinct().take(11)) <= 10  # more values than classes: a numeric target
    forest = (RandomForestClassifier if few else RandomForestRegressor)(labelCol="quality", numTrees=5, seed=1)
    pipe = Pipeline(stages=[StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"],
                                          handleInvalid="keep", stringOrderType="alphabetAsc"),
                            VectorAssembler(inputCols=["n_chars", "lang_i", "source_i"], outputCol="features"),
                            forest])
    fit, val = model.holdout_split(d, 0.2, key="doc_id")
    pm = pipe.fit(fit)
    return pm.transform(val).select("doc_id", "quality", F.col("prediction").cast("int").alias("predicted"))


@query("eva_permutation_importance", ("EVA-5", "SRT-2"))
def q_perm(spark, sf):
    tr, _ = _model_table(spark, sf)
    cols = [*FEATS, "district"]
    fit, val = model.holdout_split(tr, 0.2)
    m, _ = model.fit_predict(fit, val, cols, "rf", n_estimators=5)
    return model.permutation_importance(m, val.select("row_id", "target", *cols), cols, repeats=3)


@query("exp_runs_table", ("EXP-1", "EXP-2", "EXP-3", "EXP-4"))
def q_runs(spark, sf):
    base = dict(zip(runs.SPACE, ["minimum", "hierarchical", "iqr", "target", "none", "holdout", "linear"]))
    drawn = runs.draw({"n_estimators": ("int_uniform", 3, 6), "max_depth": ("int_uniform", 3, 6)}, 1, seed=7)[0]
    configs = [base, {**base, "split": "kfold", "features": "features_all"}, {**base, "encoding": "frequency", "scaling": "standard"},
               {**base, "null": "interpolate", "outlier": "none"}, {**base, "model": "rf", "params": drawn}]
    return runs.search(views.trades(spark, sf), configs, scratch_path(spark, "runs")).select("run_id", "rmse")


@query("eva_kfold_linear", ("EVA-2", "EVA-3"), with_views(f"""
, d AS (SELECT coalesce(area, (SELECT avg(area) FROM trades WHERE is_test = 0)) + bal / 500e0 AS x, target AS y, {_FOLD} AS fold FROM trades WHERE is_test = 0),
f AS (SELECT g.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM d, (SELECT DISTINCT fold FROM d) g WHERE d.fold <> g.fold GROUP BY 1)
SELECT CAST(d.fold AS INTEGER) AS fold, count(*) AS n, round(sqrt(avg(pow(y - a * x - b, 2))), 3) AS rmse,
       round(avg(abs(y - a * x - b)), 3) AS mae FROM d JOIN f ON d.fold = f.fold GROUP BY 1
""", "trades"))
def q_kfold_linear(spark, sf):
    t = nulls.fill_by_strategy(views.trades(spark, sf).where("is_test = 0"), ["area"], "mean") \
             .select("row_id", "target", (F.col("area") + F.col("bal") / F.lit(500.0)).alias("mix"))
    return model.cross_validate(model.add_folds(t, 5), ["mix"], "linear", digits=3)


@query("clu_fixed_centres", ("CLU-1", "AGG-10"), with_views(_Z + """,
c AS (SELECT CAST(p.point_id % 5 AS BIGINT) AS k, avg(z.x) AS cx, avg(z.y) AS cy
      FROM z JOIN cluster_points p ON z.point_id = p.point_id GROUP BY 1),
d AS (SELECT z.point_id, z.x, c.k, (z.x - c.cx) * (z.x - c.cx) + (z.y - c.cy) * (z.y - c.cy) AS d2 FROM z, c),
b AS (SELECT point_id, x, k, d2 FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d2, k) AS rn FROM d) WHERE rn = 1)
SELECT point_id, k AS cluster, round(sqrt(d2), 8) AS cluster_dist, count(*) OVER (PARTITION BY k) AS cluster_count,
       round(avg(x) OVER (PARTITION BY k), 2) AS x_mean, round(stddev_samp(x) OVER (PARTITION BY k), 2) AS x_std
FROM b
""", "cluster_points"))
def q_fixed_centres(spark, sf):
    z = cluster.standardize(views.cluster_points(spark, sf), ["x", "y"])
    cen = z.groupBy((F.col("point_id") % 5).alias("k")).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy")) \
           .orderBy("k").collect()  # k rows
    a = cluster.assign_to_centres(z, [(r["cx"], r["cy"]) for r in cen], ["x", "y"])
    stats = a.groupBy("cluster").agg(F.round(F.avg("x"), 2).alias("x_mean"), F.round(F.stddev_samp("x"), 2).alias("x_std"))
    return a.join(stats, "cluster").select("point_id", "cluster", F.round("cluster_dist", 8).alias("cluster_dist"),
                                           "cluster_count", "x_mean", "x_std")


@query("clu_minibatch_kmeans", "CLU-1")
def q_minibatch(spark, sf):
    pts = views.trades(spark, sf).select("row_id", "bal", "target", "contract_day")
    return cluster.minibatch_kmeans(pts, ["bal", "target", "contract_day"], k=5, batch=1000, rounds=12, id_col="row_id")


def _two_rounds_sql(k, batch, seed):
    """Two rounds of mini-batch k-means over ``bal`` and ``target``."""
    h = [f"((row_id % 2147483648) * {hash_multiplier(seed + e)}) % 4294967296" for e in (0, 1)]

    def nearest(src, centres):
        return f"""SELECT * FROM (SELECT {src}.*, {centres}.j, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d2,
          row_number() OVER (PARTITION BY row_id ORDER BY (x - cx) * (x - cx) + (y - cy) * (y - cy), {centres}.j) AS rn FROM {src}, {centres}) WHERE rn = 1"""

    return with_views(f"""
, st AS (SELECT avg(bal) AS mx, stddev_pop(bal) AS sx, avg(target) AS my, stddev_pop(target) AS sy, CAST(ceil(count(*) / {batch}e0) AS BIGINT) AS m FROM trades),
z AS (SELECT row_id, (bal - mx) / sx AS x, (target - my) / sy AS y, {h[0]} AS h, ({h[0]}) % m = 0 AS in0,
             CASE WHEN m = 1 THEN TRUE ELSE ({h[0]}) % m = 1 END AS in1 FROM trades, st),
b0 AS (SELECT * FROM z WHERE in0), b1 AS (SELECT * FROM z WHERE in1),
c0 AS (SELECT row_number() OVER (ORDER BY h, id) - 1 AS j, x AS cx, y AS cy FROM (
        SELECT x, y, min(h) AS h, arg_min(row_id, h) AS id FROM z WHERE in0 OR in1 GROUP BY x, y ORDER BY 3, 4 LIMIT {k})),
n0 AS ({nearest("b0", "c0")}),
s0 AS (SELECT j, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM n0 GROUP BY j),
c1 AS (SELECT c0.j, coalesce(cx + (s0.sx - n * cx) / n, cx) AS cx, coalesce(cy + (s0.sy - n * cy) / n, cy) AS cy, coalesce(n, 0) AS given
       FROM c0 LEFT JOIN s0 ON c0.j = s0.j),
n1 AS ({nearest("b1", "c1")}),
s1 AS (SELECT j, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM n1 GROUP BY j),
c2 AS (SELECT c1.j, coalesce(cx + (s1.sx - n * cx) / (given + n), cx) AS cx, coalesce(cy + (s1.sy - n * cy) / (given + n), cy) AS cy
       FROM c1 LEFT JOIN s1 ON c1.j = s1.j),
f AS ({nearest("z", "c2")})
SELECT row_id, j AS cluster, round(sqrt(d2), 6) AS cluster_dist, count(*) OVER (PARTITION BY j) AS cluster_count FROM f
""", "trades")


@query("clu_minibatch_two_rounds", "CLU-1", _two_rounds_sql(4, 4000, 42))
def q_two_rounds(spark, sf):
    pts = views.trades(spark, sf).select("row_id", "bal", "target")
    got = cluster.minibatch_kmeans(pts, ["bal", "target"], k=4, batch=4000, rounds=2, seed=42, id_col="row_id")
    return got.select("row_id", "cluster", F.round("cluster_dist", 6).alias("cluster_dist"), "cluster_count")


@query("exp_seeded_search", ("EXP-1", "EXP-2", "EXP-3", "EXP-4"))
def q_seeded_search(spark, sf):
    """Six seeded configurations in which every option of every axis comes up."""
    path = scratch_path(spark, "search")
    best = runs.search(views.trades(spark, sf), runs.covering_draw(6, seed=2023), path)
    tried = spark.read.parquet(path).select("run_id", "config", "rmse", F.get_json_object("metrics", "$.stopped").alias("stopped"))
    return tried.join(best.select("run_id", F.lit(True).alias("best")), "run_id", "left").withColumn("best", F.coalesce("best", F.lit(False)))
