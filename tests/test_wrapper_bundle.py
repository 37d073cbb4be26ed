"""Wrapper selection with callers' estimators and scores, and the selection bundle."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from places import SF001
from tessera.operators import boost, select, wrapper
from tessera.operators.model import add_folds
from tessera.sources import files, views

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        a, b, c, d = (float(v) for v in rng.normal(size=4))
        rows.append((i, None if i % 17 == 0 else a, b, c, float("inf") if i == 5 else d, None if i == 7 else 3 * a - 2 * b + 0.2 * float(rng.normal())))
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, target double").repartition(3)


def least_squares():
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(solver="normal")


def plain_rows(spark, df):
    """The rows as numpy, with nulls filled by the mean, and their folds."""
    rows = [r for r in add_folds(df, 3).collect() if r.target is not None]
    x = np.array([[math.nan if r[c] is None or not math.isfinite(r[c]) else r[c] for c in COLS] for r in rows])
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    return x, np.array([r.target for r in rows]), np.array([r.fold for r in rows])


def plain_scores(x, y, fold, cols):
    """(mean, std) over the folds of the mean absolute error of least squares."""
    out = []
    for f in sorted(set(fold)):
        one = np.column_stack([np.ones(len(y)), x[:, cols]])
        beta = np.linalg.lstsq(one[fold != f], y[fold != f], rcond=None)[0]
        out.append(float(np.mean(np.abs(y[fold == f] - one[fold == f] @ beta))))
    return float(np.mean(out)), float(np.std(out))


def test_forward_selection_equals_plain(spark, table):
    x, y, fold = plain_rows(spark, table)
    got = wrapper.forward_selection(table, COLS, "target", wrapper.MLEstimator(least_squares))
    chosen, sizes = [], []
    while len(chosen) < 4:
        best = min((plain_scores(x, y, fold, [*chosen, c])[0], c) for c in range(4) if c not in chosen)[1]
        chosen = [*chosen, best]
        sizes.append(plain_scores(x, y, fold, chosen))
    assert [n for n, *_ in got.sizes] == [1, 2, 3, 4] and got.sizes[-1][3] == [COLS[i] for i in chosen]
    assert all(math.isclose(m, p, rel_tol=1e-6) and math.isclose(s, q, rel_tol=1e-5) for (_, m, s, _), (p, q) in zip(got.sizes, sizes))
    assert got.chosen == [COLS[i] for i in chosen[:int(np.argmin([p for p, _ in sizes])) + 1]]
    assert {r.best for r in got.table(spark).collect()} == {True, False}


def test_elimination_drops_the_weakest_by_steps(spark, table):
    got = wrapper.recursive_elimination(table, COLS, "target", wrapper.MLEstimator(least_squares()))
    assert [n for n, *_ in got.sizes] == [4, 3, 2, 1] and set(got.sizes[2][3]) == {"a", "b"}
    assert {"a", "b"} <= set(got.chosen)
    by_two = wrapper.recursive_elimination(table, COLS, "target", wrapper.MLEstimator(least_squares), step=2, concurrency=1)
    assert [n for n, *_ in by_two.sizes] == [4, 2, 1]
    x, y, fold = plain_rows(spark, table)
    assert math.isclose(got.sizes[0][1], plain_scores(x, y, fold, [0, 1, 2, 3])[0], rel_tol=1e-6)


def test_own_score_and_own_estimators(spark, table):
    within = wrapper.Score(lambda y, p: F.avg((F.abs(y - p) < 1).cast("double")), greater_is_better=True)
    from pyspark.ml.regression import DecisionTreeRegressor
    for est in (wrapper.MLEstimator(DecisionTreeRegressor(maxDepth=3)), wrapper.BoostEstimator(boost.Settings(rounds=8, depth=2))):
        got = wrapper.forward_selection(table, ["a", "c"], "target", est, within)
        assert got.sizes[0][3] == ["a"] and 0 < got.sizes[0][1] < 1
    with pytest.raises(ValueError):
        wrapper.forward_selection(table, ["a"], "target", wrapper.MLEstimator(least_squares), wrapper.Score(lambda y, p: F.max(F.lit(None).cast("double"))))
    folds = wrapper.cross_validate(table, COLS, "target", wrapper.MLEstimator(least_squares), {"within": within, "mae": wrapper.MAE}, folds=3).collect()
    assert [r.fold for r in folds] == [0, 1, 2] and all(r.within > 0.8 and r.mae < 0.8 for r in folds)


def test_k_best_takes_any_score_function(spark, table):
    got = wrapper.select_k_best(table, COLS, "target", select.f_regression, 2)
    assert [r["column"] for r in got.collect()] == ["a", "b"]
    longest = lambda df, cols, target: df.sparkSession.createDataFrame([(c, float(ord(c))) for c in cols], "column string, score double")
    assert [r["column"] for r in wrapper.select_k_best(table, COLS, "target", longest, 3).collect()] == ["d", "c", "b"]


def test_bundle_is_read_back_from_its_json(spark, table):
    text = table.withColumn("t", F.when(F.col("a") > 0, "x").otherwise("y")).withColumn("u", F.col("t")).withColumn("cls", F.col("t"))
    finite = text.withColumn("d", F.when(F.col("d") < 1e300, F.col("d")))
    got = wrapper.selection_bundle(finite, COLS, ["t", "u"], "target", wrapper.MLEstimator(least_squares), k=2, class_label="cls")
    back = files.read_selection(spark, files.write_selection(got, f"{spark.conf.get('spark.checkpoint.dir')}/bundle-test"))
    rows = sorted(map(tuple, got.collect()))
    assert sorted(map(tuple, back.collect())) == rows
    sets = {k: [f for *_, f in v] for k, v in itertools.groupby(rows, key=lambda r: r[:2])}
    assert sets["cramers_v", "dropped"] == ["u"] and sets["k_best", "numeric"] == ["a", "b"]
    for name, (one, two) in {"filter": (("variance", "selected"), ("correlation", "selected")), "wrapper": (("rfe", "selected"), ("sfs", "selected"))}.items():
        a, b = set(sets.get(one, [])), set(sets.get(two, []))
        assert set(sets.get((name, "common"), [])) == a & b and set(sets[name, "union"]) == a | b
        assert set(sets.get((name, "rest"), [])) == set(COLS) - (a | b)


def test_correlation_of_a_constant_is_null(spark):
    t = views.trades(spark, SF001)
    got = {(r.c1, r.c2): r.r for r in select.corr_pairs(t, ["bal", "mostly_null", "target"]).collect()}
    assert got["bal", "mostly_null"] is None and got["bal", "target"] is not None


def test_bundle_and_folds_compute_their_rows_once(spark, monkeypatch):
    """The rows come from a join; neither the fits nor the filters may run it again."""
    from tessera.operators import model
    keys = spark.range(60).withColumn("k", F.col("id") % 7)
    side = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 3 % 5).cast("double").alias("b"), F.concat(F.lit("t"), F.col("id") % 2).alias("t"))
    df = keys.join(F.broadcast(side), "k").select(F.col("id").alias("row_id"), "b", "t", (F.col("id") % 11).cast("double").alias("a")) \
             .withColumn("u", F.concat("t", F.col("row_id") % 3)).withColumn("target", 2 * F.col("a") - F.col("b") + F.col("row_id") % 2)
    scored = model.cross_validate(model.add_folds(df, 3), ["a", "b"], "linear")
    assert "Join" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r.n for r in scored.collect()) == 60
    tables, plans = [], []
    made, vif = wrapper.fold_table, wrapper.select.vif
    monkeypatch.setattr(wrapper, "fold_table", lambda d, *a, **k: tables.append(1) or made(d, *a, **k))
    monkeypatch.setattr(wrapper.select, "vif", lambda d, *a, **k: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or vif(d, *a, **k))
    from pyspark.ml.regression import LinearRegression
    got = wrapper.selection_bundle(df, ["a", "b"], ["t", "u"], "target", wrapper.MLEstimator(lambda: LinearRegression()), k=1, class_label="t")
    assert {"vif", "filter", "k_best", "rfe", "sfs"} & {r.method for r in got.collect()}
    assert len(tables) == 1 and "Join" not in plans[0]
