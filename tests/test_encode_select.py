"""Encoders and selection statistics vs. hand computations."""

import math

import pytest

from pyspark.sql import functions as F

import numpy as np
import pandas as pd

from tessera.operators import encode, select


def test_label_codes_append_unseen_sorted(spark):
    tr = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    te = spark.createDataFrame([("z",), ("a",), ("c",)], "c string")
    codes = {r.value: r.code for r in encode.label_codes(tr, te, "c").collect()}
    assert codes == {"NULL": 0, "a": 1, "b": 2, "c": 3, "z": 4}


def test_rare_codes_other(spark):
    tr = spark.createDataFrame([(v,) for v in "aaabbc"], "c string")
    te = spark.createDataFrame([("a",), ("c",), ("q",)], "c string")
    freq, codes = encode.rare_codes(tr, "c", 2)
    got = [r.c for r in encode.apply_rare(te, "c", freq, codes).collect()]
    m = {r.value: r.code for r in codes.collect()}
    assert m == {"OTHER": 0, "a": 1, "b": 2}
    assert sorted(got) == sorted([1, 0, 0])


def test_target_encoding_unseen_global_mean(spark):
    tr = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "c string, y double")
    te = spark.createDataFrame([("a",), ("z",)], "c string")
    means, g = encode.target_means(tr, "c", "y")
    got = {r.c_te if False else r.c: r.te for r in encode.apply_target_means(
        te, "c", means, g, out="te").collect()}
    assert got == {"a": 2.0, "z": 14.0 / 3}


def test_vif_three_columns_closed_form(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=500)
    b = a * 0.7 + rng.normal(size=500)
    c = rng.normal(size=500) + b * 0.3
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    got = {r.column: r.vif for r in select.vif(spark.createDataFrame(pdf), ["a", "b", "c"], digits=10).collect()}
    r = pdf.corr().to_numpy()
    inv = np.linalg.inv(r)
    for i, k in enumerate("abc"):
        assert math.isclose(got[k], inv[i, i], rel_tol=1e-8)


def plain_cramers_v(a, b, corrected):
    """From the definition, on lists (None: 'missing')."""
    x, y = ([("missing" if v is None else v) for v in c] for c in (a, b))
    o = pd.crosstab(pd.Series(x), pd.Series(y)).to_numpy(float)
    n, (r, k) = o.sum(), o.shape
    e = np.outer(o.sum(1), o.sum(0)) / n
    dev = np.abs(o - e)
    if (r, k) == (2, 2):
        dev = dev - np.minimum(0.5, dev)
    phi2 = (dev ** 2 / e).sum() / n
    if not corrected:
        return math.sqrt(phi2 / (min(r, k) - 1))
    shrink = [m - (m - 1) ** 2 / (n - 1) for m in (r, k)]
    return math.sqrt(max(0.0, phi2 - (r - 1) * (k - 1) / (n - 1)) / (min(shrink) - 1))


def test_vif_flags_only_the_dependent_columns(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=500), rng.normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "twin": a, "b": b, "one": np.ones(500)}))
    got = {r.column: r for r in select.vif(df, ["a", "twin", "b"]).collect()}
    assert got["a"].flagged and got["twin"].flagged and not got["b"].flagged and got["b"].vif < 1.1


def test_scores_of_constant_and_perfect_columns(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, i % 2) for i in range(40)], "y double, x double, c double, g int")
    f = {r.column: r.f for r in select.f_regression(df, ["x", "c"], "y").collect()}
    assert f["x"] == math.inf and f["c"] is None
    assert [r.column for r in select.select_by_target_corr(df, ["x", "c"], "y", 0.5).collect()] == ["x"]
    assert {r.column: r.mi for r in select.mutual_info(df, ["c"], "g").collect()}["c"] == 0.0
    select.anova_f(df, ["c"], "g").collect()


def test_column_name_operators(spark):
    from tessera.operators import schema
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b-c` int, `Unnamed: 0` int")
    assert schema.drop_unnamed(df).columns == ["a", "b-c"]
    assert schema.clean_names_word(df).columns == ["a", "b_c", "Unnamed__0"]
    cov = schema.coverage(df, ["a"], ["b-c"], groups=["g"])
    assert cov == {"absent_groups": ["g"], "unlisted": ["Unnamed: 0"], "listed_absent": []}
    assert schema.find_columns(df, "nam") == ["Unnamed: 0"]


def test_cramers_table_equals_pairwise(spark):
    rng = np.random.default_rng(9)
    n = 2000
    a = rng.choice(["x", "y"], n)
    b = np.where(rng.random(n) < 0.7, a, rng.choice(["x", "y"], n))
    c = rng.choice(["p", "q", "r", None], n)
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    df = spark.createDataFrame(pdf)
    pairs = [("a", "b"), ("a", "c"), ("b", "c")]
    got = {(r.c1, r.c2): r.v for r in select.cramers_table(df, pairs, digits=12).collect()}
    plain = {(r.c1, r.c2): r.v for r in select.cramers_table(df, pairs, corrected=False, digits=12).collect()}
    for x, y in pairs:
        assert math.isclose(got[(x, y)], plain_cramers_v(pdf[x], pdf[y], True), rel_tol=1e-9, abs_tol=1e-11)
        assert math.isclose(plain[(x, y)], plain_cramers_v(pdf[x], pdf[y], False), rel_tol=1e-9, abs_tol=1e-11)


def test_target_means_oof_excludes_own_fold(spark):
    rows = [(1, "a", 10.0, 0), (2, "a", 20.0, 1), (3, "a", 30.0, 1), (4, "b", 5.0, 0), (5, "c", 7.0, 2)]
    df = spark.createDataFrame(rows, "row_id long, c string, y double, fold int")
    got = {r.row_id: r.te for r in encode.target_means_oof(df, "c", "y", "fold", out="te").collect()}
    assert got[1] == 25.0 and got[2] == 10.0 and got[3] == 10.0
    # 'b' only in fold 0 -> out-of-fold global mean of folds 1, 2
    assert got[4] == (20.0 + 30.0 + 7.0) / 3
    assert got[5] == (10.0 + 20.0 + 30.0 + 5.0) / 4


def test_rename_on_clash_and_dedup_report(spark):
    from tessera.operators import combine, schema
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a")
    out, mapping = schema.rename_on_clash(df)
    assert out.columns == ["feature_0", "feature_1"] and mapping == {"feature_0": "a", "feature_1": "a"}
    d = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    kept, rep = combine.drop_duplicates_report(d)
    r = rep.first()
    assert kept.count() == 2 and (r.rows_before, r.rows_after, r.removed) == (3, 2, 1)


def test_seeds_deal_rows_out_anew(spark):
    from tessera.functions.scalar import fold_of, is_holdout
    ids = spark.range(-5000, 20000)
    a, b = is_holdout("id", 0.2, 2023), is_holdout("id", 0.2, 2024)
    r = ids.agg(F.avg(a.cast("int")).alias("a"), F.avg((a & b).cast("int")).alias("both"), F.min(fold_of("id", 5, 3)).alias("lo"),
                F.avg((fold_of("id", 5, 1) == fold_of("id", 5, 2)).cast("int")).alias("same")).first()
    assert abs(r.a - 0.2) < 0.02 and abs(r.both - 0.04) < 0.02 and abs(r.same - 0.2) < 0.03 and r.lo == 0


def test_table_diff_bag_semantics(spark):
    from tessera.operators.combine import table_diff
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "w")], "k int, v string")
    r = table_diff(a, b).first()
    assert (r.only_left, r.only_right) == (a.exceptAll(b).count(), b.exceptAll(a).count()) == (2, 2)


def test_bootstrap_exact_size_and_power_refine(spark):
    from tessera.operators import combine, scale
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    s = combine.bootstrap_exact(df, 120, key="k", seed=3)
    assert s.count() == 120
    assert combine.bootstrap_exact(df.where("k < 100"), 1500, key="k").count() == 1500
    d = spark.range(1, 3000).select((F.col("id") * F.col("id") / 100.0).alias("x"))
    lam0, l0 = scale.power_lambda(d, "x")
    lam1, l1 = scale.power_lambda_refined(d, "x")
    assert l1 >= l0 and abs(lam1 - lam0) < 0.1 + 1e-9


def test_gram_cv_rmse_equals_numpy_ols(spark):
    from tessera.functions.scalar import fold_of
    from tessera.operators import model
    rng = np.random.default_rng(12)
    n = 600
    pdf = pd.DataFrame({"row_id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "c": rng.normal(size=n)})
    pdf["target"] = 2 * pdf.a + 0.5 * pdf.b + rng.normal(scale=0.3, size=n)
    df = spark.createDataFrame(pdf)
    folds = df.select("row_id", fold_of("row_id", 3).alias("f")).toPandas().set_index("row_id")["f"]
    grams = model.fold_gram(model.add_folds(df, 3), ["a", "b", "c"], "target")
    got_mean, got_std = model.cv_rmse_subset(grams, [0, 1])
    scores = []
    for f in sorted(folds.unique()):
        tr, va = pdf[folds.loc[pdf.row_id].to_numpy() != f], pdf[folds.loc[pdf.row_id].to_numpy() == f]
        X = np.column_stack([np.ones(len(tr)), tr.a, tr.b])
        beta = np.linalg.lstsq(X, tr.target, rcond=None)[0]
        pred = np.column_stack([np.ones(len(va)), va.a, va.b]) @ beta
        scores.append(np.sqrt(np.mean((va.target - pred) ** 2)))
    assert math.isclose(got_mean, float(np.mean(scores)), rel_tol=1e-8)
    assert math.isclose(got_std, float(np.std(scores)), rel_tol=1e-6, abs_tol=1e-9)
    rows = model.forward_selection(df, ["a", "b", "c"], "target", 3)
    assert rows[0][1] == "a" and rows[1][1] == "b"


def test_gram_sums_take_every_row(spark):
    from tessera.operators import model
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 3))
    x[:, 2] += x[:, 0]
    y, holes = x @ [2.0, 0.5, 0.0] + rng.normal(size=300), rng.random((300, 3)) < 0.3
    rows = [(i, *(None if h else float(v) for v, h in zip(x[i], holes[i])), None, float(y[i])) for i in range(300)]
    rows[0] = (0, float("inf"), *rows[0][2:])
    rows[1] = (1, rows[1][1], float("nan"), *rows[1][3:])
    holes[0, 0] = holes[1, 1] = True
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, target double")

    def filled(how):
        return np.column_stack([np.where(h, how(v[~h]), v) for v, h in zip(x.T, holes.T)])

    grams = model.fold_gram(model.add_folds(df, 3), ["a", "b", "c", "d"], "target")
    full = np.column_stack([np.ones(300), filled(np.mean), np.zeros(300)])
    assert np.allclose(sum(g for g, _, _ in grams.values()), full.T @ full)
    assert np.allclose(sum(b for _, b, _ in grams.values()), full.T @ y)
    r = np.linalg.inv(np.corrcoef(filled(np.median).T))
    got = {v.column: v.vif for v in select.vif(df, ["a", "b", "c"], digits=10).collect()}
    assert np.allclose([got[c] for c in "abc"], np.diag(r))
    assert select.gram(df, ["a", "b", "c"])[1] == select.gram(df, ["a", "b", "c"], centered=False)[1] == 300


def test_schema_split_types_blank_and_prediction_sink(spark):
    import os
    import tempfile
    from tessera.operators import nulls, schema
    from tessera.sources import files
    df = spark.createDataFrame([(1, "a", 2.5, 10.0, 0)], "row_id long, s string, x double, target double, is_test int")
    feats, y = schema.xy_split(df)
    assert feats.columns == ["row_id", "s", "x"] and y.columns == ["row_id", "target"]
    assert schema.numeric_categorical(df, exclude=["row_id"]) == (["x", "target", "is_test"], ["s"])
    b = nulls.blank_columns(df, ["x"])
    assert b.schema["x"].dataType == df.schema["x"].dataType and b.first().x is None
    base = tempfile.mkdtemp(prefix="tessera-pred-", dir="/tmp")
    path = files.write_predictions(df.withColumn("target", F.lit(12.9)), base, "r1")
    assert os.path.basename(path) == "run=r1"
    assert spark.read.parquet(path).first().target == 12   # truncated as astype(int)
    with pytest.raises(Exception):
        files.write_predictions(df, base, "r1")             # an existing run folder is an error

def test_runs_read_every_axis_and_refuse_unknown_options(spark):
    from places import SF001
    from tessera.operators import runs
    from tessera.sources import views
    assert len(list(runs.grid())) == 6 * 2 * 3 * 3 * 3 * 2 * 4
    t = views.trades(spark, SF001)
    base = dict(zip(runs.SPACE, ["minimum", "interpolate", "none", "frequency", "none", "holdout", "linear"]))
    prefix = runs.cut_lineage(runs.prepared(t, "interpolate", "none"), "test_prefix")
    scores = [runs.run_config(t, {**base, **change}, prefix)["rmse"] for change in ({}, {"features": "manual"}, {"encoding": "target"}, {"scaling": "log_target"})]
    assert len(set(scores)) == len(scores) and all(math.isfinite(s) for s in scores)
    folds = runs.run_config(t, {**base, "split": "kfold"}, prefix)
    assert len(folds["folds"]) == 5 and math.isclose(folds["rmse"], sum(folds["folds"]) / 5) and folds["n_valid"] == prefix.count()
    for bad in ({"features": "none such"}, {"colour": "red"}):
        with pytest.raises(ValueError):
            runs.run_config(t, bad, prefix)


def test_encoders_fit_once_and_apply_what_they_wrote(spark):
    """Two text columns with nulls and unseen values: both sides read the written state, so
    their plans fit nothing again."""
    from tessera.operators import runs
    train = spark.createDataFrame([("a", "x", 1.0), ("a", None, 3.0), ("b", "y", 8.0), (None, "x", 4.0)], "c string, d string, target double")
    test = spark.createDataFrame([("a", "y", 0.0), ("z", None, 0.0), (None, "w", 0.0)], "c string, d string, target double")
    want = {
        "target": ({(2.0, 2.5, 1.0), (2.0, None, 3.0), (8.0, 8.0, 8.0), (None, 2.5, 4.0)}, {(2.0, 8.0, 0.0), (4.0, 4.0, 0.0)}),
        "frequency": ({(2.0, 2.0, 1.0), (2.0, 1.0, 3.0), (1.0, 1.0, 8.0), (1.0, 2.0, 4.0)}, {(2.0, 1.0, 0.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0)}),
        "label": ({(1, 1, 1.0), (1, 0, 3.0), (2, 2, 8.0), (0, 1, 4.0)}, {(1, 2, 0.0), (3, 0, 0.0), (0, 3, 0.0)}),
    }
    for how, sides in want.items():
        for got, rows in zip(runs._encoded(train, test, ["c", "d"], how), sides):
            assert got.columns == ["c", "d", "target"] and {tuple(r) for r in got.collect()} == rows
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert "Aggregate" not in plan and "Window" not in plan and plan.count("LogicalRDD") == 1, (how, plan)
