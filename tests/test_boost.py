"""Regularised boosting against trees grown by trying every split of every row list."""

import math
import random

import pytest

from tessera.operators import boost


def plain_tree(rows, edges, s, features, depth, node=0):
    """{leaf rows' keys: value} of a tree over [(key, bins, gradient)]."""
    def soft(g):
        return math.copysign(max(abs(g) - s.l1, 0.0), g)

    def score(part):
        g = sum(r[2] for r in part)
        return soft(g) ** 2 / (len(part) + s.l2)

    best = None
    if depth:
        for f in features:
            for below in range(1, len(edges[f]) + 1):
                for missing_left in (True, False):
                    left = [r for r in rows if (missing_left if r[1][f] < 0 else r[1][f] < below)]
                    right = [r for r in rows if not (missing_left if r[1][f] < 0 else r[1][f] < below)]
                    if len(left) < s.min_rows or len(right) < s.min_rows:
                        continue
                    gain = (score(left) + score(right) - score(rows)) / 2 - s.gamma
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9 * max(1.0, abs(best[0]))):
                        best = gain, left, right
    if best is None:
        value = -soft(sum(r[2] for r in rows)) / (len(rows) + s.l2)
        return {r[0]: value for r in rows}
    return plain_tree(best[1], edges, s, features, depth - 1) | plain_tree(best[2], edges, s, features, depth - 1)


@pytest.mark.parametrize("change", [{}, {"l1": 40.0}, {"gamma": 900.0}, {"l2": 7.5, "min_rows": 6}, {"l1": 10.0, "l2": 0.0, "gamma": 50.0, "depth": 4}])
def test_boosting_equals_plain_trees(spark, change):
    rng = random.Random(3)
    rows = []
    for i in range(180):
        a, b = rng.choice([None, 1.0, 2.0, 3.0, 5.0, 8.0]), rng.gauss(0, 1)
        rows.append((i, a, round(b, 1), float("nan") if i % 11 == 0 else float(i % 4), (a or 4) * 20 + 15 * b + rng.random()))
    rows.append((500, 1.0, 0.0, 0.0, None))  # no label: takes no part
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, target double").repartition(4)
    s = boost.Settings(**{"rounds": 3, "depth": 3, "rate": 0.5, "bins": 16, **change})
    features = ["a", "b", "c"]
    model = boost.fit(df, features, settings=s, write_every=2)
    given = [r for r in rows if r[4] is not None]

    def bin_of(x, edges):
        return -1 if x is None or math.isnan(x) else sum(x >= e for e in edges)

    pred = {r[0]: model.base for r in given}
    bins = {r[0]: [bin_of(r[1 + f], model.edges[f]) for f in range(3)] for r in rows}
    for _ in range(s.rounds):
        got = plain_tree([(r[0], bins[r[0]], pred[r[0]] - r[4]) for r in given], model.edges, s, range(3), s.depth)
        pred = {k: v + s.rate * got[k] for k, v in pred.items()}
    out = {r.row_id: r.prediction for r in model.predict(df, per_step=2).collect()}
    assert set(out) == {r[0] for r in rows}
    assert all(math.isclose(out[k], v, rel_tol=1e-9, abs_tol=1e-9) for k, v in pred.items())
    assert math.isclose(sum(v for _, v in model.importances()), 1.0) or not any(t.splits for t in model.trees)


def test_boosting_leaves_samples_and_nothing(spark):
    rows = [(i, float(i % 7), float(i % 3), 3.0 * (i % 7) + (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, target double")
    few = boost.fit(df, ["a", "b"], settings=boost.Settings(rounds=1, depth=5, leaves=3, rate=1.0))
    assert len(few.trees[0].splits) == 2
    one = boost.Settings(rounds=4, depth=2, subsample=0.5, colsample=0.5, seed=9)
    first, again = (boost.fit(df, ["a", "b"], settings=one) for _ in range(2))
    shape = lambda m: [{i: (s.feature, s.below, s.missing_left) for i, s in t.splits.items()} for t in m.trees]
    assert shape(first) == shape(again) and all(len({s.feature for s in t.splits.values()}) <= 1 for t in first.trees)
    assert all(math.isclose(v, again.trees[i].values[k], rel_tol=1e-9, abs_tol=1e-12) for i, t in enumerate(first.trees) for k, v in t.values.items())
    empty = boost.fit(df.where("false"), ["a", "b"])
    assert empty.trees == [] and {r.prediction for r in empty.predict(df).collect()} == {0.0}
    same = boost.fit(df.selectExpr("row_id", "1.0D AS a", "2.0D AS b", "target"), ["a", "b"], settings=boost.Settings(rounds=2))
    assert not any(t.splits for t in same.trees)
