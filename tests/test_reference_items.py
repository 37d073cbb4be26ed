"""Block sums of distances, the date line and dense cells, mini-batch k-means, quantile
bins, Spearman pair by pair, and the search over shared steps."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from places import SF001
from tessera.functions.scalar import hash_multiplier
from tessera.operators import cluster, geo, profile, runs, select
from tessera.sources import views


def km(a, b):
    la1, lo1, la2, lo2 = (math.radians(v) for v in (*a, *b))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_distance_sums_do_not_depend_on_the_block(spark):
    rng = random.Random(2)
    at = [(i, rng.choice([None, rng.uniform(126, 128)]) if i % 9 == 0 else rng.uniform(126, 128), rng.uniform(37, 38)) for i in range(60)] + [(99, 127.0, 37.5)] * 3
    pts = [(rng.uniform(126, 128), rng.uniform(37, 38)) for _ in range(40)] + [(127.0, 37.5)] * 5 + [(None, 37.0)]
    df = spark.createDataFrame(at, "row_id long, lon double, lat double")
    points = spark.createDataFrame(pts, "lon double, lat double").repartition(3)
    found = []
    for block, per_pass in ((1000, 4), (7, 2), (1, 50)):
        got = geo.distance_sums(df, points, block=block, per_pass=per_pass).collect()
        assert len(got) == len(at)
        found.append(sorted(((r.row_id, r.lon, r.lat, r.distance_sum) for r in got), key=str))
    assert found[0] == found[1] == found[2]
    for _, x, y, s in found[0]:
        want = None if x is None else sum(math.hypot(x - a, y - b) for a, b in pts if a is not None)
        assert s == want or math.isclose(s, want, rel_tol=1e-12)
    none = geo.distance_sums(df, points.where("false")).collect()
    assert {r.distance_sum for r in none} == {None, 0.0}
    plan = geo.distance_sums(df, points, block=7)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_points_meet_across_the_date_line_and_dense_cells_split(spark):
    rng = random.Random(6)
    near = [(0.0005 * rng.random() + 10, 180 - 0.002 * rng.random()) for _ in range(25)] + [(10.0, -180 + 0.001 * i) for i in range(25)]
    pois = [(10.0002, 179.9995), (10.0003, -179.9992), (10.0, -179.99), (-5.0, 0.0), (89.5, 10.0), (89.5, -170.0)]
    locs = [*near, (89.6, 100.0), (-5.001, 0.001), (45.0, 45.0)]
    ldf = geo.locations(spark.createDataFrame(locs, "lat double, lon double"))
    pdf = spark.createDataFrame([(i, *p) for i, p in enumerate(pois)], "poi_id long, lat double, lon double")
    for mal in (None, 89.6):
        for r_km in (0.3, 5.0, 300.0):
            for most in (10_000, 3):
                mx = mal or max(abs(a) for a, _ in [*locs, *pois])
                got = {(r.loc_id, r.poi_id) for r in geo.candidate_pairs(ldf, pdf, r_km, mx, most=most).collect()}
                at = {r.loc_id: (r.lat, r.lon) for r in ldf.collect()}
                assert got == {(i, j) for i, a in at.items() for j, p in enumerate(pois) if km(a, p) <= r_km}
    nearest = {(r.lat, r.lon): r.nearest_km for r in geo.nearest(ldf, pdf, 0.1).collect()}
    for a, d in nearest.items():
        assert math.isclose(d, min(km(a, p) for p in pois), rel_tol=1e-9, abs_tol=1e-9)


def test_minibatch_centres_equal_a_plain_run(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(3 * (i % 3), 0.5), rng.gauss(-2 * (i % 3), 0.5)) for i in range(500)] + [(900, None, 1.0), (901, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "point_id long, x double, y double").repartition(4)
    for k, batch, rounds in ((3, 120, 7), (4, 1000, 3), (600, 50, 2)):
        got = cluster.minibatch_centres(df, ["x", "y"], k, batch, rounds, seed=5)
        pts = [r for r in rows if r[1] is not None and not math.isnan(r[1])]
        m = max(1, -(-len(pts) // batch))
        h = lambda i, e: (i % 2147483648) * hash_multiplier(5 + e) % 4294967296
        drawn = [[r for r in pts if h(r[0], t // m) % m == t % m] for t in range(rounds)]
        first = {}
        for r in {r for own in drawn for r in own}:
            first[r[1:]] = min(first.get(r[1:], (1 << 40, 0)), (h(r[0], 0), r[0]))
        centres = sorted(first, key=first.get)[:k]
        given = [0] * len(centres)
        for own in drawn:
            near = [min(range(len(centres)), key=lambda j: ((r[1] - centres[j][0]) ** 2 + (r[2] - centres[j][1]) ** 2, j)) for r in own]
            new = list(centres)
            for j in set(near):
                mine = [r for r, n in zip(own, near) if n == j]
                given[j] += len(mine)
                new[j] = tuple(c + (sum(r[i + 1] for r in mine) - len(mine) * c) / given[j] for i, c in enumerate(centres[j]))
            centres = new
        assert len(got) == len(centres) and np.allclose(got, centres, rtol=1e-9)
    assert cluster.minibatch_centres(df.where("false"), ["x", "y"]) == []


def test_spearman_skips_nulls_pair_by_pair(spark):
    rng = random.Random(3)
    rows = [tuple(None if rng.random() < 0.2 else float(rng.randint(0, 8)) for _ in range(3)) + (1.0,) for _ in range(300)] + [(2.0, 2.0, 2.0, 1.0)] * 200
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(5)
    want = pd.DataFrame(rows, columns=list("abck")).corr("spearman")
    got = profile.spearman_pairs(df, list("abck")).collect()
    assert len(got) == 6
    for r in got:
        w = want.loc[r.c1, r.c2]
        assert (r.rho is None and math.isnan(w)) or math.isclose(r.rho, w, abs_tol=1e-8)
    assert all(r.rho is None for r in profile.spearman_pairs(df.where("false"), ["a", "b"]).collect())


@pytest.mark.parametrize("how", ["width", "quantile"])
def test_mutual_information_in_a_fixed_number_of_jobs(spark, how):
    rng = random.Random(8)
    rows = [(None if i % 13 == 0 else rng.gauss(0, 1), float(i % 3), rng.choice([None, "u", "v"]), None, None if i % 31 == 0 else i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, t string, e double, y int")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("mi"))
    got = {r["column"]: r.mi for r in select.mutual_info(df, ["a", "b", "t", "e"], "y", bins=5, how=how).collect()}
    for c, at in (("a", 0), ("b", 1), ("t", 2)):
        every = [r[at] for r in rows if r[at] is not None]
        own = [(r[at], r[4]) for r in rows if r[at] is not None and r[4] is not None]
        if c != "t":
            if how == "width":
                lo, hi = min(every), max(every)
                bin_of = lambda v: min(4, int((v - lo) / ((hi - lo) / 5)))
            else:
                edges = sorted(set(np.quantile(every, [0.2, 0.4, 0.6, 0.8])))
                bin_of = lambda v: sum(v > e for e in edges)
            own = [(bin_of(v), y) for v, y in own]
        t = pd.crosstab(*map(list, zip(*own))).to_numpy() / len(own)
        outer = t.sum(1, keepdims=True) * t.sum(0, keepdims=True)
        assert math.isclose(got[c], float((t[t > 0] * np.log(t[t > 0] / outer[t > 0])).sum()), rel_tol=1e-9)
    assert got["e"] is None and jobs() == 0
    counts = []
    for cols in (["a"], ["a", "b", "t", "e"]):
        spark.sparkContext.setJobGroup(f"mi-{len(cols)}", "")
        select.mutual_info(df, cols, "y", how=how)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"mi-{len(cols)}")))
    spark.sparkContext.setJobGroup("", "")
    assert counts[1] <= counts[0] + 3


def test_seeded_search_covers_the_axes_and_shares_steps(spark, tmp_path, monkeypatch):
    configs = runs.covering_draw(6, seed=11)
    assert configs == runs.covering_draw(6, seed=11) != runs.covering_draw(6, seed=12)
    assert all({c[k] for c in configs} == set(v) for k, v in runs.SPACE.items())
    assert len({json.dumps(c) for c in runs.covering_draw(60, seed=1)}) == 60
    with pytest.raises(ValueError):
        runs.covering_draw(5)
    t = views.trades(spark, SF001)
    base = dict(zip(runs.SPACE, ["minimum", "interpolate", "iqr", "frequency", "none", "holdout", "linear"]))
    made = []
    real = runs.cut_lineage
    monkeypatch.setattr(runs, "cut_lineage", lambda df, name: made.append(name) or real(df, name))
    tried = [base, {**base, "scaling": "standard"}, {**base, "features": "manual"}, {**base, "outlier": "none"}]
    best = runs.search(t, tried, str(tmp_path / "runs"))
    assert sorted(made) == sorted(["run_null", "run_outlier"] + ["run_train", "run_valid"] * 3)
    logged = {r.run_id: r for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert len(logged) == 4 and best.first().rmse == min(r.rmse for r in logged.values())
    assert logged["run-0"].rmse == pytest.approx(runs.run_config(t, base)["rmse"])
    early = runs.run_config(t, {**base, "split": "kfold"}, stop_above=0.0)
    assert early["stopped"] and len(early["folds"]) == 2
    runs.log_run(spark, str(tmp_path / "runs"), base, {**early, "rmse": 0.0}, "run-stopped")
    assert runs.best_run(spark, str(tmp_path / "runs")).first().run_id != "run-stopped"
    assert spark.read.parquet(str(tmp_path / "runs")).where(F.col("run_id") == "run-stopped").count() == 1


def test_distance_sums_fold_arrays_not_rows_of_expressions(spark):
    """Many points: each place takes them as arrays in Python workers; a fold by an
    expression, pair after pair, is too slow for tables of this library's size."""
    rng = random.Random(5)
    places = [(i, rng.uniform(126, 128), rng.uniform(37, 38)) for i in range(700)]
    points = [(rng.uniform(126, 128), rng.uniform(37, 38)) for _ in range(300)] + [(-53.0, -37.5), places[0][1:]]
    df = spark.createDataFrame(places, "row_id long, lon double, lat double")
    pdf = spark.createDataFrame(points, "lon double, lat double")
    for metric, distance in (("plane", lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1])), ("km", lambda a, b: km(a[::-1], b[::-1]))):
        got = geo.distance_sums(df, pdf, metric=metric, block=100, per_pass=50)
        assert "aggregate(" not in got._jdf.queryExecution().optimizedPlan().toString()
        found = {r.row_id: r.distance_sum for r in got.collect()}
        for i, *at in places[:40]:
            assert math.isclose(found[i], sum(distance(at, p) for p in points), rel_tol=1e-11)
