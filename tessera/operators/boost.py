"""MDL-2: gradient boosting with L1, L2 and split penalties.

Trees are grown level by level on histograms.  Features are cut into bins once and
written with the label; a level is one aggregation of gradients and counts by (node,
feature, bin), summed up in every task before the shuffle, and only that table, whose
size follows from depth, features and bins, reaches the driver.  There the best split
of each node is found by the penalised gain

    gain = (T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2)) / 2 - gamma

with T(G) = sign(G) max(|G| - l1, 0); a leaf's value is -T(G) / (H + l2).  The loss is
squared error, so a row's hessian is 1 and H a count.  Missing values have a bin of
their own that goes to the better side.  Rows (``subsample``) and features
(``colsample``) of a tree are drawn by hash and by seed.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_unit
from ..sources.store import cut_lineage


@dataclass(frozen=True)
class Settings:
    rounds: int = 20
    depth: int = 6
    rate: float = 0.3
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    min_rows: float = 1.0
    bins: int = 64
    subsample: float = 1.0
    colsample: float = 1.0
    leaves: int | None = None
    seed: int = 1


@dataclass
class Split:
    """Rows of a bin below ``below`` go left; missing ones where ``missing_left``
    says.  ``left`` and ``right``: sums of gradients and counts of the two sides."""

    feature: int
    below: int
    missing_left: bool
    gain: float
    left: tuple[float, float]
    right: tuple[float, float]


@dataclass
class Tree:
    """Nodes are numbered as in a heap: the children of i are 2 i + 1 and 2 i + 2."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)


@dataclass
class Booster:
    features: list[str]
    edges: list[list[float]]
    base: float
    settings: Settings
    trees: list[Tree] = field(default_factory=list)

    def importances(self) -> list[tuple[str, float]]:
        """Total gain of each feature, as shares, greatest first."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for s in tree.splits.values():
                total[self.features[s.feature]] += s.gain + self.settings.gamma
        all_ = sum(total.values()) or 1.0
        return sorted(((f, g / all_) for f, g in total.items()), key=lambda t: (-t[1], t[0]))

    def predict(self, df: DataFrame, out: str = "prediction", per_step: int = 10) -> DataFrame:
        """``df`` with the predictions; trees are summed ``per_step`` at a time."""
        got = df.withColumn("_bins", binned(self.features, self.edges)).withColumn(out, F.lit(self.base))
        for lo in range(0, len(self.trees), per_step):
            got = got.withColumn(out, sum((self.settings.rate * leaf_value(t) for t in self.trees[lo:lo + per_step]), F.col(out)))
        return got.drop("_bins")


def bin_edges(df: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Inner bin edges of each feature: distinct approximate quantiles, from one sketch a column."""
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), probs, accuracy).alias(f"q{i}") for i, x in enumerate(F.col(f).cast("double") for f in features)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(len(features))]


def binned(features: Sequence[str], edges: list[list[float]]) -> Column:
    """Array of each feature's bin: the number of edges not above the value; missing is -1."""
    out = []
    for f, own in zip(features, edges):
        x = F.col(f).cast("double")
        out.append(F.when(x.isNull() | F.isnan(x), F.lit(-1)).otherwise(_search(x, own, 0, len(own))))
    return F.array(*out)


def _search(x: Column, edges: list[float], lo: int, hi: int) -> Column:
    """Binary search as nested conditions."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x < F.lit(edges[mid]), _search(x, edges, lo, mid)).otherwise(_search(x, edges, mid + 1, hi))


def node_of(tree: Tree, bins: str = "_bins") -> Column:
    """The node that a row ends in, so far as the tree is grown."""
    def walk(i: int) -> Column:
        s = tree.splits.get(i)
        if s is None:
            return F.lit(i)
        b = F.get(bins, F.lit(s.feature))
        left = (b < s.below) if s.missing_left else (b >= 0) & (b < s.below)
        return F.when(left, walk(2 * i + 1)).otherwise(walk(2 * i + 2))
    return walk(0)


def leaf_value(tree: Tree) -> Column:
    def walk(i: int) -> Column:
        s = tree.splits.get(i)
        if s is None:
            return F.lit(tree.values.get(i, 0.0))
        b = F.get("_bins", F.lit(s.feature))
        left = (b < s.below) if s.missing_left else (b >= 0) & (b < s.below)
        return F.when(left, walk(2 * i + 1)).otherwise(walk(2 * i + 2))
    return walk(0)


def shrunk(g: float, l1: float) -> float:
    return float(np.sign(g) * max(abs(g) - l1, 0.0))


def leaf_weight(g: float, h: float, s: Settings) -> float:
    return -shrunk(g, s.l1) / (h + s.l2) if h + s.l2 > 0 else 0.0


def best_split(g: np.ndarray, h: np.ndarray, s: Settings) -> Split | None:
    """The best split of a node from its histograms: ``g`` and ``h`` have a row for
    each feature and a column for each bin, the last one for missing values.  Ties go
    to the lower feature, the lower bin, then to missing values on the left."""
    def score(gg, hh):
        t = np.sign(gg) * np.maximum(np.abs(gg) - s.l1, 0.0)
        return np.divide(t * t, hh + s.l2, out=np.zeros_like(gg), where=hh + s.l2 > 0)

    total_g, total_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    gains, lefts = [], []
    for miss in (1.0, 0.0):
        left_g = np.cumsum(g[:, :-1], axis=1)[:, :-1] + miss * g[:, -1:]
        left_h = np.cumsum(h[:, :-1], axis=1)[:, :-1] + miss * h[:, -1:]
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = 0.5 * (score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)) - s.gamma
        lefts.append(np.stack([left_g, left_h]))
        gains.append(np.where((left_h >= s.min_rows) & (right_h >= s.min_rows), gain, -np.inf))
    both = np.stack(gains, axis=-1)  # feature, bin, side of missing values
    if not both.size or not np.isfinite(both.max()) or both.max() <= 1e-12:
        return None
    top = both.max()
    f, b, m = (int(v) for v in np.argwhere(both >= top - 1e-9 * max(1.0, abs(top)))[0])
    left = lefts[m][:, f, b]
    right = np.array([total_g[f, 0], total_h[f, 0]]) - left
    return Split(f, b + 1, m == 0, float(both[f, b, m]), tuple(left.tolist()), tuple(right.tolist()))


def _histograms(rows: DataFrame, node: Column, active: Sequence[int], features: Sequence[int], width: int):
    """{node: (gradients, counts)}, arrays of (all features, bins), from one aggregation."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.get("_bins", F.lit(f)).alias("b")) for f in features]))
    got = (rows.select(node.alias("node"), (F.col("_pred") - F.col("_y")).alias("g"), "_bins").where(F.col("node").isin(list(active)))
           .select("node", "g", cells.alias("c")).groupBy("node", "c.f", "c.b").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("h")).toPandas())
    out = {}
    for i in active:
        own = got[got["node"] == i]
        g, h = np.zeros((len(features), width)), np.zeros((len(features), width))
        place = {f: k for k, f in enumerate(features)}
        at = own["f"].map(place).to_numpy(np.int64), own["b"].to_numpy(np.int64)  # missing: -1, the last column
        g[at], h[at] = own["g"].to_numpy(float), own["h"].to_numpy(float)
        out[i] = g, h
    return out


def grow(rows: DataFrame, features: Sequence[int], width: int, s: Settings) -> Tree:
    """One tree on rows (``_bins``, ``_y``, ``_pred``), level by level."""
    tree, active, leaves = Tree(), [0], 1
    for _ in range(s.depth):
        found = _histograms(rows, node_of(tree), active, features, width)
        if not tree.values:
            tree.values[0] = leaf_weight(float(found[0][0][0].sum()), float(found[0][1][0].sum()), s)
        wanted = [(split.gain, -i, split) for i in active if (split := best_split(*found[i], s)) is not None]
        active = []
        for _, i, split in sorted(wanted, key=lambda w: w[:2], reverse=True):
            if s.leaves is not None and leaves >= s.leaves:
                break  # the splits of greatest gain come first
            split.feature = features[split.feature]
            tree.splits[-i] = split
            leaves += 1
            for child, side in ((2 * -i + 1, split.left), (2 * -i + 2, split.right)):
                tree.values[child] = leaf_weight(*side, s)
                active.append(child)
        active.sort()
        if not active:
            break
    return tree


def fit(df: DataFrame, features: Sequence[str], label: str = "target", key: str = "row_id", settings: Settings = Settings(),
        write_every: int = 4) -> Booster:
    """A booster of the rows that have a label.  ``key``: integer row key for
    ``subsample``.  Binned rows are written once; the running predictions every
    ``write_every`` trees."""
    s, features = settings, list(features)
    data = df.where(F.col(label).isNotNull())
    edges = bin_edges(data, features, s.bins)
    base = data.agg(F.avg(F.col(label).cast("double"))).first()[0]
    booster = Booster(features, edges, float(base or 0.0), s)
    if base is None:
        return booster
    width = max(len(e) for e in edges) + 2  # bins and the one of missing values
    rows = cut_lineage(data.select(F.col(key).cast("bigint").alias("_key"), F.col(label).cast("double").alias("_y"), binned(features, edges).alias("_bins"))
                       .withColumn("_pred", F.lit(booster.base)), "boost_rows")
    for r in range(s.rounds):
        drawn = rows if s.subsample >= 1 else rows.where(hash_unit("_key", s.seed * 100_003 + r) < int(s.subsample * 2**32))
        n = max(1, round(s.colsample * len(features)))
        own = sorted(random.Random(s.seed * 100_003 + r).sample(range(len(features)), n)) if n < len(features) else list(range(len(features)))
        tree = grow(drawn, own, width, s)
        booster.trees.append(tree)
        rows = rows.withColumn("_pred", F.col("_pred") + s.rate * leaf_value(tree))
        if r % write_every == write_every - 1 and r + 1 < s.rounds:
            rows = cut_lineage(rows, "boost_rows")
    return booster
