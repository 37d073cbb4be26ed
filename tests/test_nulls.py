"""Null operators vs. pandas semantics."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import nulls


def test_interpolate_matches_pandas_across_buckets(spark):
    rng = np.random.default_rng(3)
    n = 4000
    v = rng.normal(50, 10, n)
    v[rng.random(n) < 0.3] = np.nan
    v[:7] = np.nan           # leading nulls stay null
    v[-11:] = np.nan         # trailing nulls take the last value
    v[1000:1900] = np.nan    # a gap spanning whole buckets
    ids = np.sort(rng.choice(10**9, n, replace=False))
    pdf = pd.DataFrame({"row_id": ids, "v": v})
    expect = pdf["v"].interpolate(method="linear")
    df = spark.createDataFrame(pdf.sample(frac=1.0, random_state=1))
    got = nulls.interpolate(df, ["v"], "row_id", rows_per_bucket=128).toPandas().set_index("row_id").loc[ids, "v"]
    assert np.allclose(got.to_numpy(), expect.to_numpy(), equal_nan=True, rtol=1e-12, atol=1e-9)


def _pandas_hfill(pdf, num, txt, groups):
    out = pdf.copy()
    for k in range(len(groups), 0, -1):
        g = groups[:k]
        for c in num:
            m = out.groupby(g)[c].transform("mean")
            out[c] = out[c].fillna(m)
        for c in txt:
            def mode(s):
                s = s.dropna()
                if s.empty:
                    return None
                vc = s.value_counts()
                return sorted(vc[vc == vc.max()].index)[0]
            m = out.groupby(g)[c].transform(mode)
            out[c] = out[c].fillna(m)
    for c in num:
        out[c] = out[c].fillna(out[c].mean())
    for c in txt:
        vc = out[c].dropna().value_counts()
        out[c] = out[c].fillna(sorted(vc[vc == vc.max()].index)[0] if len(vc) else "Unknown")
    return out


def test_hierarchical_fill_matches_sequential_pandas(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({
        "a": rng.choice(["A", "B", "C", "D"], n), "b": rng.choice(["x", "y", "z"], n),
        "c": rng.choice([f"c{i}" for i in range(40)], n),
        "v": rng.normal(10, 3, n), "t": rng.choice(["p", "q", "r", "s"], n)})
    pdf.loc[rng.random(n) < 0.3, "v"] = np.nan
    pdf.loc[pdf["c"].isin(["c1", "c2", "c3"]), "v"] = np.nan
    pdf.loc[pdf["a"] == "D", "v"] = np.nan
    pdf.loc[rng.random(n) < 0.3, "t"] = None
    pdf.loc[pdf["a"] == "C", "t"] = None
    pdf["rid"] = np.arange(n)
    expect = _pandas_hfill(pdf, ["v"], ["t"], ["a", "b", "c"]).set_index("rid")
    got = nulls.hierarchical_fill(spark.createDataFrame(pdf), ["v"], ["t"], ["a", "b", "c"]).toPandas().set_index("rid")
    got = got.loc[expect.index]
    assert np.allclose(got["v"], expect["v"], rtol=1e-9)
    assert (got["t"] == expect["t"]).all()


def test_drop_sparse_and_sentinels(spark):
    df = spark.createDataFrame([(1, " ", None), (2, "-", None), (3, "x", None), (4, "y", 1.0)],
                               "id int, s string, z double")
    out = nulls.drop_sparse_columns(nulls.sentinels_to_null(df, ["s"]), max_ratio=0.6)
    assert out.columns == ["id", "s"]  # s: 2/4 null kept, z: 3/4 null dropped
    assert [r.s for r in out.orderBy("id").collect()] == [None, None, "x", "y"]


def test_strategy_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "v double")
    got = sorted(r.v for r in nulls.fill_by_strategy(df, ["v"], "median").collect())
    assert got == [1.0, 3.0, 3.0, 10.0]


def test_interpolate_by_group_matches_pandas_with_hot_group(spark):
    rng = np.random.default_rng(21)
    n = 4000
    g = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))   # one group holds most rows
    v = rng.normal(10, 2, n)
    v[rng.random(n) < 0.35] = np.nan
    ids = np.sort(rng.choice(10**8, n, replace=False))
    pdf = pd.DataFrame({"row_id": ids, "g": g, "v": v})
    expect = pdf.groupby("g")["v"].transform(lambda s: s.interpolate(method="linear"))
    got = nulls.interpolate_by_group(spark.createDataFrame(pdf), ["v"], "g", "row_id", rows_per_bucket=200) \
               .toPandas().set_index("row_id").loc[ids, "v"]
    assert np.allclose(got.to_numpy(), expect.to_numpy(), equal_nan=True, rtol=1e-12, atol=1e-9)
