"""Distributed order and exact quantiles vs. numpy / pandas on small frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.quantiles import quantiles, values_at_ranks
from tessera.operators.ordering import range_buckets, with_position


def test_with_position_dense_and_ordered(spark):
    rng = np.random.default_rng(1)
    keys = rng.choice(10_000_000, size=5000, replace=False)
    df = spark.createDataFrame(pd.DataFrame({"k": keys.astype("int64")}))
    got = with_position(df, "k", "pos", rows_per_bucket=300).toPandas().sort_values("k")
    assert list(got["pos"]) == list(range(len(keys)))


def test_with_position_text_keys(spark):
    vals = [f"v{i:05d}" for i in range(3000)][::-1]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = with_position(df, "v", "pos", rows_per_bucket=100).toPandas().sort_values("v")
    assert list(got["pos"]) == list(range(3000))


def test_with_position_null_and_large_keys(spark):
    for n, rows in ((40, 2_000_000), (4000, 100)):
        big = [(None if i % 5 == 0 else 2**60 + i,) for i in range(n)]
        got = with_position(spark.createDataFrame(big, "k long"), "k", "pos", rows_per_bucket=rows).orderBy("pos").collect()
        assert [r.pos for r in got] == list(range(n))
        keys = [r.k for r in got]
        assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and keys.count(None) == n // 5
    text = [(None,)] * 3 + [(f"v{i:06d}",) for i in range(3000)]
    got = with_position(spark.createDataFrame(text, "v string"), "v", "pos", rows_per_bucket=5).collect()  # 600 buckets
    assert sorted(r.pos for r in got) == list(range(3003))


def test_range_buckets_monotone(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    b, n = range_buckets(df, "k", rows_per_bucket=1000)
    assert n > 1
    agg = b.groupBy("_bucket").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("_bucket").collect()
    for a, c in zip(agg, agg[1:]):
        assert a["hi"] < c["lo"]


@pytest.mark.parametrize("small", [200_000, 50])
def test_exact_quantiles_match_pandas(spark, small):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.lognormal(3, 1, 4000), np.full(800, 12.5), [np.nan] * 50])
    pdf = pd.DataFrame({"x": x})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles(df, ["x"], probs, small=small, accuracy=200)
    for p in probs:
        assert got[("x", p)] == pytest.approx(pdf["x"].quantile(p), rel=1e-12, abs=1e-12)


def test_values_at_ranks_narrowing_rounds(spark):
    # force the sketch path: few distinct allowed in the exact stage
    df = spark.range(0, 100_000).select((F.col("id") * 7 % 100_003).cast("double").alias("x"))
    vals = sorted(r[0] for r in df.collect())
    ranks = [0, 1, 4999, 50000, 99999]
    got = values_at_ranks(df, [("x", r) for r in ranks], small=100, accuracy=100)
    for r in ranks:
        assert got[("x", r)] == vals[r]


def test_quantiles_edge_cases(spark):
    df = spark.createDataFrame([(None, 5, 1), (None, 5, 2), (None, 5, 3), (None, 5, 4)], "a double, b int, c int")
    q = quantiles(df, ["a", "b", "c"], [0.0, 0.5, 0.9])
    assert q[("a", 0.5)] is None
    assert q[("b", 0.0)] == q[("b", 0.9)] == 5.0
    assert q[("c", 0.5)] == pytest.approx(pd.Series([1, 2, 3, 4]).quantile(0.5))
    assert q[("c", 0.9)] == pytest.approx(pd.Series([1, 2, 3, 4]).quantile(0.9))
