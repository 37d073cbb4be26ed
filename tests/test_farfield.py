"""Distance sums by tiles equal those by pairs, and their work does not grow with the pairs."""

import math

import numpy as np
import pytest

from tessera.operators import farfield, geo


def _by_pairs(metric, x, y, px, py, w):
    out = []
    for a, b in zip(x, y):
        if metric == "plane":
            d = np.hypot(px - a, py - b)
        else:
            la, pla = math.radians(b), np.radians(py)
            h = np.sin((pla - la) / 2) ** 2 + math.cos(la) * np.cos(pla) * np.sin(np.radians(px - a) / 2) ** 2
            d = 2 * 6371.0 * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(1 - h, 0.0)))
        out.append(math.fsum(d * w))
    return np.array(out)


def _spread(kind, n, rng):
    if kind == "box":
        return 126.5 + rng.random(n), 37 + rng.random(n)
    if kind == "globe":
        return -180 + 360 * rng.random(n), np.degrees(np.arcsin(2 * rng.random(n) - 1))
    if kind == "pole":
        return -180 + 360 * rng.random(n), 90 - 3 * rng.random(n) ** 2
    if kind == "date line":
        return 180 * np.sign(rng.random(n) - 0.5) + rng.normal(0, 0.5, n), rng.normal(0, 20, n)
    middle = np.array([(127.0, 37.5), (-53.0, -37.5), (127.3, 37.5), (0.0, 0.0)])[rng.integers(0, 4, n)]  # two are antipodes
    at = middle + rng.normal(0, 0.01, (n, 2)) * 10.0 ** rng.integers(-3, 2, (n, 1))
    return at[:, 0], at[:, 1]


@pytest.mark.parametrize("kind", ["box", "globe", "pole", "date line", "clumps"])
def test_sums_of_far_boxes_are_exact(kind):
    rng = np.random.default_rng(5)
    (x, y), (px, py) = _spread(kind, 5000, rng), _spread(kind, 9000, rng)
    x[:3], y[:3] = px[:3], py[:3]
    w = rng.integers(1, 4, len(px)).astype(float)
    for metric in ("plane", "km"):
        got = farfield.sums(metric, x, y, [(px[i::2], py[i::2], w[i::2]) for i in range(2)])
        some = np.append(np.arange(3), rng.integers(0, len(x), 40))
        rtol = 1e-10 if (kind, metric) == ("clumps", "km") else 2e-13  # arc sines of about 1 have few digits, by pairs too
        assert np.allclose(got[some], _by_pairs(metric, x[some], y[some], px, py, w), rtol=rtol, atol=0)


def test_small_boxes_far_from_the_origin_lose_no_digits():
    rng = np.random.default_rng(6)
    x, y = 1e8 + rng.random(3000), -3e7 + rng.random(3000)
    px, py = np.append(1e8 + rng.random(8000), 0.0), np.append(-3e7 + rng.random(8000), 0.0)
    got = farfield.sums("plane", x, y, [(px[:-1], py[:-1], np.ones(8000))])
    assert np.allclose(got[:40], _by_pairs("plane", x[:40], y[:40], px[:-1], py[:-1], 1.0), rtol=1e-12, atol=0)
    got = farfield.sums("plane", x, y, [(px, py, np.ones(8001))])
    assert np.allclose(got[:40], _by_pairs("plane", x[:40], y[:40], px, py, 1.0), rtol=1e-13, atol=0)


def test_work_grows_with_the_rows_not_with_the_pairs(monkeypatch):
    rng, measured = np.random.default_rng(7), []
    monkeypatch.setattr(farfield.Plane, "sums", staticmethod(lambda t, s, w, far: measured.append(t.shape[1] * s.shape[1]) or np.zeros(t.shape[1])))
    seen = []
    for n in (30_000, 120_000):
        measured.clear()
        (x, y), (px, py) = _spread("box", n, rng), _spread("box", n, rng)
        farfield.sums("plane", x, y, [(px, py, np.ones(n))])
        seen.append(sum(measured))
    assert seen[1] < 7 * seen[0]  # pairs: 16 times
    assert seen[1] < 120_000 ** 2 / 3


@pytest.mark.parametrize("metric", ["plane", "km"])
def test_tiles_give_what_pairs_give(spark, metric):
    rng = np.random.default_rng(8)
    (x, y), (px, py) = _spread("box", 2500, rng), _spread("box", 6000, rng)
    px[:2000] = 126.5 + 0.01 * rng.random(2000)  # a denser strip
    inf = float("inf")
    odd = [(2500, 127.0, None), (2501, None, 37.0), (2502, float("nan"), 37.0), (2503, 127.0, 95.0), (2504, 1e200, 37.0), (2505, inf, 1.0)]
    places = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))] + odd + [(2506, float(px[0]), float(py[0]))], "row_id long, lon double, lat double")
    rows = [(float(a), float(b)) for a, b in zip(px, py)]
    points = spark.createDataFrame(rows + rows[:50] + [(None, 1.0)], "lon double, lat double")
    w = np.ones(len(px))
    w[:50] = 2.0
    for extra in ([], [(10.0, 95.0), (1e5, 2.0)]):
        sent = points.unionByName(spark.createDataFrame(extra, points.schema)) if extra else points
        got = {r.row_id: r.s for r in geo.distance_sums(places, sent, "s", metric=metric, few_pairs=0, tile_rows=1500).collect()}
        want = {r.row_id: r.s for r in geo.distance_sums(places, sent, "s", metric=metric).collect()}
        assert got.keys() == want.keys() and len(got) == 2507
        for i, s in want.items():
            same = got[i] is None if s is None else math.isnan(got[i]) if math.isnan(s) else got[i] == s or math.isclose(got[i], s, rel_tol=1e-12)
            assert same, (i, got[i], s)
        if not extra:
            some = rng.integers(0, 2500, 30)
            assert np.allclose([got[int(i)] for i in some], _by_pairs(metric, x[some], y[some], px, py, w), rtol=1e-12, atol=0)
