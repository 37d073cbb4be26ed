"""DBSCAN by cells: against a plain run, and on a clump of very many distinct points."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster


def plain_dbscan(pts, eps, k):
    """Labels numbered by smallest core id; a border point takes its smallest cluster."""
    near = {i: [j for j, (a, b) in pts.items() if (a - x) * (a - x) + (b - y) * (b - y) <= eps * eps] for i, (x, y) in pts.items()}
    core = {i for i, n in near.items() if len(n) >= k}
    label = {}
    for i in sorted(core):
        if i not in label:
            label[i], todo = i, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j in core and j not in label:
                        label[j] = i
                        todo.append(j)
    for i in set(pts) - core:
        own = [label[j] for j in near[i] if j in core]
        if own:
            label[i] = min(own)
    codes = {v: n for n, v in enumerate(sorted(set(label.values())))}
    return {i: codes[label[i]] if i in label else -1 for i in pts}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dbscan_equals_plain(spark, seed):
    rng = random.Random(seed)
    eps, k = 0.2, rng.choice([3, 5, 8])
    pts = {}
    for i in range(420):
        kind = rng.random()
        if kind < 0.4:
            x, y = rng.gauss(rng.choice([0, 1, 2]), 0.15), rng.gauss(0, 0.1)
        elif kind < 0.7:  # a lattice of the cells' own corners, where distances are exactly eps or just beyond
            x, y = round(rng.uniform(3, 5) / 0.1) * 0.1, round(rng.uniform(-1, 1) / 0.2) * 0.2
        elif kind < 0.8:
            x, y = 6.0, 0.25 * rng.randint(0, 3)
        else:
            x, y = rng.uniform(-1, 7), rng.uniform(-2, 2)
        pts[i * 3 + 1] = (x, y)
    df = spark.createDataFrame([(i, *p) for i, p in pts.items()], "point_id long, x double, y double").repartition(4)
    got = {r.point_id: r.label for r in cluster.dbscan(df, eps, k).collect()}
    assert got == plain_dbscan(pts, eps, k)


def test_dbscan_of_a_clump_lists_no_point_pairs(spark, monkeypatch):
    n = 100_000
    clump = spark.range(n).select(F.col("id").alias("point_id"), (F.col("id") * 7919 % 100_003 / 100_003.0).alias("x"),
                                  (F.col("id") * 104_729 % 100_019 / 100_019.0).alias("y"))
    far = spark.createDataFrame([(n, 1.19, 0.5), (n + 1, 9.0, 9.0)], "point_id long, x double, y double")
    written = []
    real = cluster.cut_lineage
    monkeypatch.setattr(cluster, "cut_lineage", lambda df, *name: written.append(real(df, *name)) or written[-1])
    got = cluster.dbscan(clump.union(far), 0.2, 5)
    assert {(r.label, r["count"]) for r in got.groupBy("label").count().collect()} == {(0, n + 1), (-1, 1)}
    assert max(d.count() for d in written) <= n + 2
    assert cluster.dbscan(far.where("false")).count() == 0
