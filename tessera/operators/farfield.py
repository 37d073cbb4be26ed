"""Sums of distances to all points, with every pair in them but not every pair measured alone (GEO-8).

A distance is a smooth function of both ends wherever they lie well apart.  So the points of a
box stand on the ``ORDER`` x ``ORDER`` Chebyshev nodes of the box with weights that give the same sums
to any place far from it, and the sums at the places of a box follow from those at its own nodes
(the fast multipole method, with the kernel itself as the expansion).  Boxes that are not far
are halved down to ``LEAF`` places and points, which are measured pair by pair.

What is far is decided by where the distance, as a function of one coordinate continued to the complex plane,
stops being smooth: no nearer to the box than ``APART`` of its half widths.  Then each interpolation is within
4 M rho^(1 - ORDER) / (rho - 1), rho = APART + sqrt(1 + APART^2), M the largest value near the box: under 1e-15 of it,
as small as the rounding of the sums themselves.  No point, place or weight is left out.  Coordinates are kept
relative to the middles of boxes, so nothing is lost where a box is small and far from the origin.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from numpy.polynomial.chebyshev import chebvander

from ..functions.scalar import EARTH_RADIUS_KM

#: Chebyshev nodes a side, and half widths between a box and what its nodes may stand in for.
ORDER, APART = 24, 2.25
#: Places or points that a box may have without being halved.
LEAF = 800
#: Pairs held at a time.
HELD = 32_768

_NODES = np.cos((2 * np.arange(ORDER) + 1) * np.pi / (2 * ORDER))
_TO_NODES = chebvander(_NODES, ORDER - 1).T * np.where(np.arange(ORDER) == 0, 1.0, 2.0)[:, None] / ORDER


def _middle(low, high):
    half = (high - low) / 2
    return low + half, half


def _values(offset, half):
    """Values, that far from the middle, of the polynomials that are 1 at one node of an interval and 0 at the others."""
    return chebvander(offset / half if half > 0 else np.zeros(len(offset)), ORDER - 1) @ _TO_NODES


def _basis(v, low, high):
    mid, half = _middle(low, high)
    return _values(v - mid, half)


def _handed(inner, outer):
    """The same at the nodes of an inner interval, one matrix for either axis."""
    out = []
    for i in (0, 2):
        (mid, half), (own, wide) = _middle(*inner[i:i + 2]), _middle(*outer[i:i + 2])
        out.append(_values((mid - own) + half * _NODES, wide))
    return out


def _grid(box):
    """The box's nodes from its middle."""
    return np.repeat(_middle(*box[:2])[1] * _NODES, ORDER), np.tile(_middle(*box[2:4])[1] * _NODES, ORDER)


def _squares(t, s, far):
    """Squared distances of the columns of ``t`` and ``s``.  Far ones are taken about the middle
    of ``t`` as one product, which near ones would lose digits in."""
    if far:
        mid = t.mean(axis=1)[:, None]
        t, s = t - mid, s - mid
        a = np.concatenate([t, (t * t).sum(axis=0)[None], np.ones((1, t.shape[1]))]).T.copy()
        b = np.concatenate([-2.0 * s, np.ones((1, s.shape[1])), (s * s).sum(axis=0)[None]])
        return lambda at: np.maximum(a @ b[:, at], 0.0)

    def near(at):
        total = np.subtract.outer(t[0], s[0, at])
        np.multiply(total, total, out=total)
        one = np.empty_like(total)
        for i in range(1, len(t)):
            np.subtract.outer(t[i], s[i, at], out=one)
            np.multiply(one, one, out=one)
            np.add(total, one, out=total)
        return total
    return near


class Plane:
    """Distances in the coordinates' own unit."""

    @staticmethod
    def at(box, dx, dy):
        """An origin, and coordinates from there, of what lies that far from the box's middle."""
        return np.array([_middle(*box[:2])[0], _middle(*box[2:4])[0]]), np.stack([dx, dy])

    @staticmethod
    def box(x0, x1, y0, y1):
        """Bounds, and the half width along either axis."""
        return x0, x1, y0, y1, (x1 - x0) / 2, (y1 - y0) / 2

    @staticmethod
    def gap(a, b):
        return math.hypot(max(0.0, a[0] - b[1], b[0] - a[1]), max(0.0, a[2] - b[3], b[2] - a[3]))

    @staticmethod
    def apart(gap, own, other):
        """Whether the nodes of ``own`` stand for its places or points at that gap from the other box."""
        return gap > 0 and gap >= APART * max(own[4], own[5])

    @staticmethod
    def widths(box):
        return box[4], box[5]

    @staticmethod
    def sums(t, s, w, far):
        total, step, squares = np.zeros(t.shape[1]), max(1, HELD // t.shape[1]), _squares(t, s, far)
        for i in range(0, s.shape[1], step):
            d2 = squares(slice(i, i + step))
            total += np.sqrt(d2, out=d2) @ w[i:i + step]
        return total


#: Taylor coefficients of arc / chord in the squared chord.
_ARC = [math.comb(2 * k, k) / (16.0 ** k * (2 * k + 1)) for k in range(12)]


class Km:
    """Great-circle distances; x is the longitude and y the latitude, in degrees."""

    @staticmethod
    def at(box, dx, dy):
        lo, la = np.radians(_middle(*box[:2])[0] + dx), np.radians(_middle(*box[2:4])[0] + dy)
        return np.zeros(3), np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)])

    @staticmethod
    def box(x0, x1, y0, y1):
        """Bounds, middle and half width of the longitude, bounds and half width of the latitude in
        radians, and the least and greatest cosine of the latitude."""
        half, lo, la0, la1 = math.radians(x1 - x0) / 2, math.radians(x0 + (x1 - x0) / 2), math.radians(y0), math.radians(y1)
        least = max(0.0, min(math.cos(la0), math.cos(la1)))
        most = 1.0 if la0 <= 0.0 <= la1 else max(math.cos(la0), math.cos(la1))
        return x0, x1, y0, y1, lo, half, la0, la1, (la1 - la0) / 2, least, most

    @staticmethod
    def gap(a, b):
        """The least chord between the boxes, or between one and the other's antipodes, where distances have a kink too."""
        between = abs(math.remainder(a[4] - b[4], 2 * math.pi))
        lo0, lo1 = max(0.0, between - a[5] - b[5]), min(math.pi, between + a[5] + b[5])
        la0, la1 = max(0.0, a[6] - b[7], b[6] - a[7]), max(a[7] - b[6], b[7] - a[6])
        least = math.sin(la0 / 2) ** 2 + a[9] * b[9] * math.sin(lo0 / 2) ** 2
        most = math.sin(la1 / 2) ** 2 + a[10] * b[10] * math.sin(lo1 / 2) ** 2
        return 2 * math.sqrt(max(0.0, min(least, 1.0 - most)))

    @staticmethod
    def apart(gap, own, other):
        cosines = math.sqrt(max(0.0, own[10] * other[10]))
        along = 2 * math.asinh(gap / (2 * cosines)) if cosines > 0 else math.inf
        return gap > 0 and gap >= APART * own[8] and along >= APART * own[5]

    @staticmethod
    def widths(box):
        return box[5] * box[10], box[8]

    @staticmethod
    def sums(t, s, w, far):
        total, step, squares = np.zeros(t.shape[1]), max(1, HELD // t.shape[1]), _squares(t, s, far)
        most = (np.maximum(t.max(axis=1) - s.min(axis=1), s.max(axis=1) - t.min(axis=1)) ** 2).sum()
        terms = next((k for k in range(9) if most < 1.0 and _ARC[k + 1] * most ** (k + 1) < 1e-17), None)
        for i in range(0, s.shape[1], step):
            d2 = squares(slice(i, i + step))
            if terms is None:
                np.sqrt(d2, out=d2)
                np.minimum(np.multiply(d2, 0.5, out=d2), 1.0, out=d2)
                arc = np.multiply(np.arcsin(d2, out=d2), 2.0, out=d2)
            else:
                arc = np.full_like(d2, _ARC[terms])
                for k in range(terms - 1, -1, -1):
                    np.multiply(arc, d2, out=arc)
                    np.add(arc, _ARC[k], out=arc)
                np.multiply(arc, np.sqrt(d2, out=d2), out=arc)
            total += arc @ w[i:i + step]
        return total * EARTH_RADIUS_KM


METRICS = {"plane": Plane, "km": Km}


class _Node:
    """A box of places or points: halves, or the places or points themselves (``own``: x, y and for places their row, for
    points their weight), and of more than ORDER^2 points the weights of the box's nodes."""
    __slots__ = ("box", "n", "kids", "own", "coef", "stands", "lists")

    def __init__(self, box, n):
        self.box, self.n, self.kids, self.own, self.coef, self.stands, self.lists = box, n, (), None, None, None, {}


def _halved(metric, x, y, v):
    node = _Node(metric.box(float(x.min()), float(x.max()), float(y.min()), float(y.max())), len(x))
    if len(x) <= LEAF:
        node.own = x, y, v
        return node
    wide = metric.widths(node.box)
    order = np.argpartition(x if wide[0] >= wide[1] else y, len(x) // 2)
    node.kids = tuple(_halved(metric, x[o], y[o], v[o]) for o in (order[:len(x) // 2], order[len(x) // 2:]))
    return node


def _onto(box, x, y, w):
    """The weights of the box's nodes that stand for points of it."""
    return _basis(x, *box[:2]).T @ (w[:, None] * _basis(y, *box[2:4]))


def _weigh(node):
    """Fills in the weights of the nodes of each box that has more points than nodes."""
    for k in node.kids:
        _weigh(k)
    if node.coef is not None or node.n <= ORDER * ORDER:
        return
    node.coef = _onto(node.box, *node.own) if node.own is not None else 0.0
    for k in node.kids:
        if k.coef is None:
            for own in _all(k):
                node.coef = node.coef + _onto(node.box, *own)
        else:
            along, across = _handed(k.box, node.box)
            node.coef = node.coef + along.T @ k.coef @ across


def _all(node):
    return [node.own] if node.own is not None else [o for k in node.kids for o in _all(k)]


def _joined(metric, nodes):
    """One node over many, halved by their middles."""
    if len(nodes) == 1:
        return nodes[0]
    ends = [f(n.box[i] for n in nodes) for i, f in enumerate((min, max, min, max))]
    node = _Node(metric.box(*ends), sum(n.n for n in nodes))
    at = 0 if metric.widths(node.box)[0] >= metric.widths(node.box)[1] else 2
    nodes = sorted(nodes, key=lambda n: n.box[at] + n.box[at + 1])
    node.kids = tuple(_joined(metric, part) for part in (nodes[:len(nodes) // 2], nodes[len(nodes) // 2:]))
    return node


def _standing(metric, node):
    """The coordinates and weights that stand for a node's points to a place far from it."""
    if node.stands is None:
        if node.coef is not None:
            node.stands = *metric.at(node.box, *_grid(node.box)), node.coef.ravel()
        else:
            x, y, w = map(np.concatenate, zip(*_all(node)))
            node.stands = *_at(metric, node.box, x, y), w
    return node.stands


def _at(metric, box, x, y):
    return metric.at(box, x - _middle(*box[:2])[0], y - _middle(*box[2:4])[0])


def _meet(metric, places, points):
    """Puts each pair of a place and a point into one list of one node: ``far`` from node to node, ``out`` from
    the points' nodes to places, ``into`` from points to the places' nodes, ``near`` from point to place."""
    todo = [(places, points)]
    while todo:
        t, s = todo.pop()
        gap = metric.gap(t.box, s.box)
        sent = not s.kids and s.own is None  # its points are elsewhere, as they are far from all places here
        out, into = sent or metric.apart(gap, s.box, t.box), metric.apart(gap, t.box, s.box)
        if out and into:
            kind = "far"
        elif not t.kids and out:
            kind = "out"
        elif not s.kids and into:
            kind = "into"
        elif not t.kids and not s.kids:
            kind = "near"
        else:
            halve = t.kids and (not s.kids or max(metric.widths(t.box)) > max(metric.widths(s.box)))
            todo += [(k, s) for k in t.kids] if halve else [(t, k) for k in s.kids]
            continue
        t.lists.setdefault(kind, []).append(s)


def _settle(metric, t, inherited, total):
    """Adds the lists of a node of places, and what its parents' nodes hand down, to the places' sums."""
    many = t.n > ORDER * ORDER
    at_nodes = inherited
    own = _all(t) if not many or t.own is not None else None
    for kind, found in t.lists.items():
        nodes = many and kind in ("far", "into")
        for x, y, rows in [(None, None, None)] if nodes else own:
            origin, places = metric.at(t.box, *_grid(t.box)) if nodes else _at(metric, t.box, x, y)
            stands = [_standing(metric, s) if kind in ("far", "out") else (*_at(metric, s.box, *s.own[:2]), s.own[2]) for s in found]
            points = np.concatenate([c + (o - origin)[:, None] for o, c, _ in stands], axis=1)
            got = metric.sums(places, points, np.concatenate([w for *_, w in stands]), nodes or kind == "far")
            if nodes:
                got = got.reshape(ORDER, ORDER)
                at_nodes = got if at_nodes is None else at_nodes + got
            else:
                total[rows] += got
    if at_nodes is None:
        for k in t.kids:
            _settle(metric, k, None, total)
        return
    for x, y, rows in [t.own] if t.own is not None else [o for k in t.kids if k.n <= ORDER * ORDER for o in _all(k)]:
        total[rows] += ((_basis(x, *t.box[:2]) @ at_nodes) * _basis(y, *t.box[2:4])).sum(axis=1)
    for k in t.kids:
        handed = None
        if k.n > ORDER * ORDER:
            along, across = _handed(k.box, t.box)
            handed = along @ at_nodes @ across.T
        _settle(metric, k, handed, total)


def sums(metric: str, x, y, tiles) -> np.ndarray:
    """The sum of weighted distances of each place to the points of all ``tiles``: (x, y, w) of one's points, or
    (box, coef, number) of one that is far from all places."""
    own, total = METRICS[metric], np.zeros(len(x))
    nodes = []
    for a, b, c in tiles:
        if isinstance(a, tuple):
            nodes.append(_Node(own.box(*a), c))
            nodes[-1].coef = b
        else:
            nodes.append(_halved(own, a, b, c))
    if len(x) and nodes:
        places, points = _halved(own, x, y, np.arange(len(x))), _joined(own, nodes)
        _weigh(points)
        _meet(own, places, points)
        _settle(own, places, None, total)
    return total


# ---------------------------------------------------------------------------
# The tables' side: tiles, what stands for them, and who needs which
# ---------------------------------------------------------------------------

def along_curve(low, high, x: str, y: str):
    """Function for ``mapInArrow``: rows with ``at``, their place along a Hilbert curve through the box."""
    bits = 31
    last = (1 << bits) - 1

    def cell(v, axis):
        wide = high[axis] - low[axis]
        return np.clip((v - low[axis]) / wide * last, 0, last).astype(np.int64) if wide > 0 else np.zeros(len(v), np.int64)

    def place(batches):
        for b in batches:
            cx, cy = cell(b[x].to_numpy(), 0), cell(b[y].to_numpy(), 1)
            at = np.zeros(len(cx), np.int64)
            for bit in range(bits - 1, -1, -1):
                rx, ry = (cx >> bit) & 1, (cy >> bit) & 1
                at = (at << 2) | ((3 * rx) ^ ry)
                flip, turn = (ry == 0) & (rx == 1), ry == 0
                cx, cy = np.where(flip, last - cx, cx), np.where(flip, last - cy, cy)
                cx, cy = np.where(turn, cy, cx), np.where(turn, cx, cy)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], [*b.schema.names, "at"])
    return place


PACKED = "_tile bigint, x0 double, x1 double, y0 double, y1 double, n bigint, px array<double>, py array<double>, w array<double>, coef array<double>"
_DOUBLES = pa.list_(pa.float64())


def packed(tile):
    """One row of a tile's points: bounds, number, the points, and the weights of its nodes if it has more points than nodes."""
    x, y, w = (tile[c].to_numpy() for c in ("x", "y", "w"))
    box = [float(x.min()), float(x.max()), float(y.min()), float(y.max())]
    coef = _onto(box, x, y, w).ravel() if len(x) > ORDER * ORDER else None
    return pa.table({"_tile": tile["_tile"][:1], **{c: [v] for c, v in zip(("x0", "x1", "y0", "y1"), box)}, "n": pa.array([len(x)], pa.int64()),
                     **{c: pa.array([v], _DOUBLES) for c, v in (("px", x), ("py", y), ("w", w), ("coef", coef))}})


def needed(metric: str):
    """Function of a part's bounds and all tiles' bounds: whether the part needs a tile's points, or its nodes will do."""
    own = METRICS[metric]

    def choose(part, tiles):
        ends = ("x0", "x1", "y0", "y1")
        here = own.box(*(part[c][0].as_py() for c in ends))
        whole = []
        for n, *box in zip(tiles["n"].to_pylist(), *(tiles[c].to_pylist() for c in ends)):
            there = own.box(*box)
            whole.append(n <= ORDER * ORDER or not own.apart(own.gap(here, there), there, here))
        return pa.table({"_part": tiles["_part"], "_tile": tiles["_tile"], "whole": pa.array(whole, pa.bool_())})
    return choose


def folded(metric: str):
    """Function of a part's places and the tiles sent to it: the places with their sums."""
    def fold(places, sent):
        tiles = []
        for i in np.argsort(sent["_tile"].to_numpy()).tolist():
            if sent["coef"][i].is_valid:
                box = tuple(sent[c][i].as_py() for c in ("x0", "x1", "y0", "y1"))
                tiles.append((box, sent["coef"][i].values.to_numpy().reshape(ORDER, ORDER), sent["n"][i].as_py()))
            else:
                tiles.append(tuple(sent[c][i].values.to_numpy() for c in ("px", "py", "w")))
        x, y = places["_x"].to_numpy(), places["_y"].to_numpy()
        return pa.table({"_x": x, "_y": y, "_sum": sums(metric, x, y, tiles)})
    return fold
