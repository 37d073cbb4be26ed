"""Grid joins equal brute force; DBSCAN equals a reference implementation."""

import math

import numpy as np
import pandas as pd

from tessera.operators import cluster, geo


def hav(lat1, lon1, lat2, lon2):
    la1, lo1, la2, lo2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_transport_features_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    pts = pd.DataFrame({"row_id": np.arange(400), "lon": 126.9 + rng.random(400) * 0.1, "lat": 37.5 + rng.random(400) * 0.1})
    pts.loc[::37, ["lon", "lat"]] = np.nan
    pts.loc[5:12, "lon"] = 128.4 + rng.random(8)  # ~130 km from every station: ring search rounds
    pois = pd.DataFrame({"poi_id": np.arange(60), "lon": 126.9 + rng.random(60) * 0.3, "lat": 37.5 + rng.random(60) * 0.3})
    got = geo.transport_features(spark.createDataFrame(pts), spark.createDataFrame(pois), "s").toPandas().set_index("row_id")
    for r in pts.itertuples():
        g = got.loc[r.row_id]
        if np.isnan(r.lon):
            assert pd.isna(g["s_shortest_distance"])
            continue
        d = [hav(r.lat, r.lon, p.lat, p.lon) * 1000 for p in pois.itertuples()]
        assert g["s_station_area_count"] == sum(x <= 200 for x in d)
        assert g["s_indirect_influence_count"] == sum(x <= 1500 for x in d)
        assert abs(g["s_shortest_distance"] - min(d)) < 1e-6
        z = 1 if min(d) <= 200 else 2 if min(d) <= 500 else 3 if min(d) <= 1500 else 0
        assert g["s_zone_type"] == z


def _dbscan_ref(x, y, ids, eps, ms):
    n = len(ids)
    nb = [[j for j in range(n) if (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 <= eps * eps] for i in range(n)]
    core = [len(v) >= ms for v in nb]
    comp = {}
    for i in sorted(range(n), key=lambda i: ids[i]):
        if not core[i] or i in comp:
            continue
        stack, seen = [i], {i}
        while stack:
            u = stack.pop()
            for v in nb[u]:
                if core[v] and v not in seen:
                    seen.add(v)
                    stack.append(v)
        m = min(ids[v] for v in seen)
        for v in seen:
            comp[v] = m
    lab = {}
    for i in range(n):
        if core[i]:
            lab[ids[i]] = comp[i]
        else:
            cs = [comp[j] for j in nb[i] if core[j]]
            lab[ids[i]] = min(cs) if cs else None
    order = sorted({v for v in lab.values() if v is not None})
    code = {v: k for k, v in enumerate(order)}
    return {k: (code[v] if v is not None else -1) for k, v in lab.items()}


def test_dbscan_equals_reference(spark):
    rng = np.random.default_rng(2)
    centers = [(0, 0), (3, 3), (0, 4)]
    pts = np.concatenate([rng.normal(c, 0.4, (120, 2)) for c in centers] + [rng.uniform(-2, 6, (40, 2))])
    ids = rng.permutation(10_000)[: len(pts)]
    pdf = pd.DataFrame({"point_id": ids, "x": pts[:, 0], "y": pts[:, 1]})
    got = cluster.dbscan(spark.createDataFrame(pdf), 0.35, 5).toPandas().set_index("point_id")["label"].to_dict()
    ref = _dbscan_ref(pdf.x.to_numpy(), pdf.y.to_numpy(), pdf.point_id.to_numpy(), 0.35, 5)
    assert got == ref


def test_k_distance_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"point_id": np.arange(300), "x": rng.random(300) * 3, "y": rng.random(300)})
    got = cluster.k_distance(spark.createDataFrame(pdf), 5, start=0.01).toPandas().set_index("point_id")["kdist"]
    xy = pdf[["x", "y"]].to_numpy()
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1))
    ref = np.sort(d, axis=1)[:, 4]
    assert np.allclose(got.loc[pdf.point_id].to_numpy(), ref)


def test_dbscan_and_kdist_with_hot_duplicate_coordinates(spark):
    rng = np.random.default_rng(8)
    base = np.concatenate([rng.normal((0, 0), 0.3, (150, 2)), rng.normal((3, 0), 0.3, (60, 2)), rng.uniform(-2, 5, (30, 2))])
    hot = np.tile([[0.1, 0.05]], (200, 1))          # a hot spot: many rows at one coordinate
    pts = np.concatenate([base, hot, base[:20]])     # plus exact duplicates of some points
    ids = rng.permutation(100_000)[: len(pts)]
    pdf = pd.DataFrame({"point_id": ids, "x": pts[:, 0], "y": pts[:, 1]})
    df = spark.createDataFrame(pdf)
    got = cluster.dbscan(df, 0.3, 5).toPandas().set_index("point_id")["label"].to_dict()
    ref = _dbscan_ref(pdf.x.to_numpy(), pdf.y.to_numpy(), pdf.point_id.to_numpy(), 0.3, 5)
    assert got == ref
    kd = cluster.k_distance(df, 5, start=0.01).toPandas().set_index("point_id")["kdist"]
    xy = pdf[["x", "y"]].to_numpy()
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1))
    assert np.allclose(kd.loc[pdf.point_id].to_numpy(), np.sort(d, axis=1)[:, 4])


def test_assign_to_centres_ties_to_lower_index(spark):
    pdf = pd.DataFrame({"point_id": [1, 2, 3], "x": [0.0, 1.0, 0.5], "y": [0.0, 0.0, 0.0]})
    got = cluster.assign_to_centres(spark.createDataFrame(pdf), [(0.0, 0.0), (1.0, 0.0)], ["x", "y"]) \
                 .toPandas().set_index("point_id")
    assert list(got.loc[[1, 2, 3], "cluster"]) == [0, 1, 0]   # point 3 is equidistant -> lower index
    assert list(got.loc[[1, 2, 3], "cluster_count"]) == [2, 1, 2]


def test_k_distance_of_clumps_lists_no_pairs(spark):
    rng = np.random.default_rng(12)
    pts = np.concatenate([rng.normal((0, 0), 1e-4, (400, 2)), rng.uniform(-50, 50, (60, 2)), np.tile([[7.0, 7.0]], (4, 1)), [[1e6, 0.0]]])
    pdf = pd.DataFrame({"point_id": np.arange(len(pts)), "x": pts[:, 0], "y": pts[:, 1]})
    df = spark.createDataFrame(pdf)
    d = np.sort(np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)), axis=1)
    for k, tile in ((5, 16), (1, 512), (9, 100)):
        got = cluster.k_distance(df, k, tile=tile)
        assert np.array_equal(got.toPandas().set_index("point_id")["kdist"].loc[pdf.point_id].to_numpy(), d[:, k - 1])
    assert cluster.k_distance(df.limit(3), 4).toPandas()["kdist"].isna().all()
    odd = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0), (3, None, 1.0), (4, float("nan"), 0.0)], "point_id long, x double, y double")
    assert {r.point_id: r.kdist for r in cluster.k_distance(odd, 2).collect()} == {1: 5.0, 2: 5.0, 4: None}


def test_transport_features_list_no_pairs(spark, monkeypatch):
    """Stacked POIs, POIs at exactly a zone's edge's side, and locations far from all POIs; no pair rows."""
    rng = np.random.default_rng(3)
    pois = [(i, 127.0 + rng.random() * 0.02, 37.5 + rng.random() * 0.02) for i in range(700)] + [(900 + i, 127.01, 37.51) for i in range(6)]
    rows = [(i, 127.0 + rng.random() * 0.02, 37.5 + rng.random() * 0.02) for i in range(60)] + [(100, 127.01, 37.51), (101, 128.5, 37.2), (102, -60.0, -37.5), (103, None, 37.5)]
    monkeypatch.setattr(geo, "candidate_pairs", None)
    got = geo.transport_features(spark.createDataFrame(rows, "row_id long, lon double, lat double"), spark.createDataFrame(pois, "poi_id long, lon double, lat double"), "s").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.lon is None:
            assert r.s_shortest_distance is None
            continue
        d = [hav(r.lat, r.lon, p[2], p[1]) * 1000 for p in pois]
        assert [r.s_station_area_count, r.s_direct_influence_count, r.s_indirect_influence_count] == [sum(x <= z for x in d) for z in (200, 500, 1500)]
        assert abs(r.s_shortest_distance - min(d)) < 1e-6
