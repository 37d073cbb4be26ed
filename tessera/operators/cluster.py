"""Clustering (CLU-1 .. CLU-4).

DBSCAN uses an eps-grid equi-join (no cross join) and links cells, not points, so a
clump gives no point pairs; k-distance compares tiles of equal counts.  Connected components come from iterative
min-label propagation over the cells' edges, with a written table
per round, so labels are global (no per-batch restarts).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_unit
from ..session import with_library
from ..sources.store import cut_lineage
from .ordering import with_position
from .scale import affine, standard_params


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population-std standardisation (the reference's StandardScaler)."""
    return affine(df, standard_params(df, list(cols)))


#: Directions in which a cell's outermost points stand for it.
DIRECTIONS = tuple((math.cos(2 * math.pi * i / 16), math.sin(2 * math.pi * i / 16)) for i in range(16))


def outermost(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row a cell: ``reps``, its outermost points in 16 directions (so at most 16,
    whatever the cell holds), and its bounding box."""
    ends = [F.max_by(F.struct("x", "y"), F.struct(F.col("x") * c + F.col("y") * s, "x", "y")) for c, s in DIRECTIONS]
    return points.groupBy(*by).agg(F.array_distinct(F.array(*ends)).alias("reps"), F.min("x").alias("x0"), F.max("x").alias("x1"),
                                   F.min("y").alias("y0"), F.max("y").alias("y1"))


def _d2(p, q):
    return (p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])


def _to_box(x, y, side: str):
    """Squared distance of a point to the box of a side of a cell pair."""
    dx = F.greatest(F.col(side + "x0") - x, x - F.col(side + "x1"), F.lit(0.0))
    dy = F.greatest(F.col(side + "y0") - y, y - F.col(side + "y1"), F.lit(0.0))
    return dx * dx + dy * dy


def near_cells(left: DataFrame, right: DataFrame, eps: float, once: bool) -> DataFrame:
    """Pairs (a, b) of a cell of ``left`` and another of ``right`` that have points
    within ``eps`` of each other; ``left`` and ``right`` hold points (cx, cy, x, y) in cells of
    side eps / sqrt(2).  ``once``: each pair in one direction only.

    A cell has at most 24 neighbours.  Most pairs are settled by the cells' outermost
    points alone; for the rest only points that are within ``eps`` of the other cell's box are
    compared, and of them a pair of cells comes out once, so no point pairs are listed."""
    offsets = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0) or not once]
    one, two = (cut_lineage(outermost(d, ["cx", "cy"]), "cell_reps") for d in (left, right))
    l = one.select(F.struct("cx", "cy").alias("a"), *[F.col(c).alias("a" + c) for c in ("reps", "x0", "x1", "y0", "y1")],
                   F.explode(F.array(*[F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")) for dx, dy in offsets])).alias("b"))
    r = two.select(F.struct("cx", "cy").alias("b"), *[F.col(c).alias("b" + c) for c in ("reps", "x0", "x1", "y0", "y1")])
    gap = lambda lo, hi: F.greatest(F.col("b" + lo) - F.col("a" + hi), F.col("a" + lo) - F.col("b" + hi), F.lit(0.0))
    boxes = F.pow(gap("x0", "x1"), 2) + F.pow(gap("y0", "y1"), 2)
    slack = 1 + 1e-9  # of bounds only: the points themselves are compared exactly
    met = F.exists("areps", lambda p: F.exists("breps", lambda q: _d2(p, q) <= eps * eps))
    pairs = cut_lineage(l.join(r, "b").where(boxes <= eps * eps * slack).withColumn("met", met), "cell_pairs")
    open_ = pairs.where(~F.col("met")).select("a", "b", *[f"{s}{c}" for s in "ab" for c in ("x0", "x1", "y0", "y1")])
    near = [d.select(F.struct("cx", "cy").alias(own), "x", "y").join(open_, own).where(_to_box(F.col("x"), F.col("y"), other) <= eps * eps * slack)
            .select("a", "b", F.struct("x", "y").alias("p" + own)) for d, own, other in ((left, "a", "b"), (right, "b", "a"))]
    found = near[0].join(near[1], ["a", "b"]).where(_d2(F.col("pa"), F.col("pb")) <= eps * eps).select("a", "b").distinct()
    return pairs.where("met").select("a", "b").union(found)


def dbscan(pts: DataFrame, eps: float = 0.5, min_samples: int = 5, id_col: str = "point_id",
           x: str = "x", y: str = "y") -> DataFrame:
    """CLU-2: (point_id, label, cluster_size); noise is -1.

    Core: at least ``min_samples`` points within eps, itself included.
    Clusters are the connected components of core points; a border point
    takes the smallest label among its core neighbours.  Labels are numbered
    0.. in order of each cluster's smallest core point id (the order a
    scan by id would discover them).

    Work is bounded for hot spots:
    * identical coordinates collapse to one location with a multiplicity;
    * the plane is cut into cells of side eps / sqrt(2), so all points of a
      cell are within eps of each other: a cell holding >= min_samples
      points makes every point in it core without counting pairs, and a
      cell is one node of the component graph;
    * a location of a sparse cell is core at once if the outermost points of the
      cells around make up ``min_samples``; neighbours are counted for the others only;
    * cells are linked, and border points attached, by ``near_cells``, which lists
      pairs of cells, not of points.
    """
    side = eps / 2 ** 0.5
    p = pts.select(F.col(id_col).alias("id"), F.col(x).alias("x"), F.col(y).alias("y"))
    loc = cut_lineage(p.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("lid"))
                      .withColumn("cx", F.floor(F.col("x") / side)).withColumn("cy", F.floor(F.col("y") / side)))
    cells = loc.groupBy("cx", "cy").agg(F.sum("w").alias("cw"))
    loc = cut_lineage(loc.join(cells, ["cx", "cy"]), "dbscan_locations")
    sparse = loc.where(F.col("cw") < min_samples)  # each such cell has < min_samples points
    around = F.explode(F.array(*[F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")) for dx in range(-2, 3) for dy in range(-2, 3)]))
    beside = (sparse.select("lid", F.struct("x", "y").alias("p"), around.alias("c")).join(
        outermost(loc, ["cx", "cy"]).select(F.struct("cx", "cy").alias("c"), "reps"), "c"))
    seen = beside.groupBy("lid").agg(F.sum(F.size(F.filter("reps", lambda q: _d2(F.col("p"), q) <= eps * eps))).alias("n"))
    sure = cut_lineage(seen.where(F.col("n") >= min_samples).select("lid"), "dbscan_sure")  # distinct points: a lower bound
    rest = sparse.join(sure, "lid", "left_anti")
    sp_pairs = eps_pairs_between(rest.select(F.col("lid").alias("point_id"), "x", "y"),
                                 loc.select(F.col("lid").alias("point_id"), "x", "y"), eps, "point_id", "x", "y")
    wts = loc.select(F.col("lid").alias("b"), F.col("w").alias("bw"))
    deg = sp_pairs.join(wts, "b").groupBy("a").agg(F.sum("bw").alias("deg"))
    core_ids = deg.where(F.col("deg") >= min_samples).select(F.col("a").alias("lid")).union(sure)
    core = cut_lineage(loc.where(F.col("cw") >= min_samples).select("lid", "x", "y", "cx", "cy")
                       .unionByName(sparse.join(core_ids, "lid").select("lid", "x", "y", "cx", "cy")), "dbscan_core")
    cell_edges = near_cells(core, core, eps, once=True)
    # a cell's smallest core point id (over every point at its core locations)
    members = p.join(loc.select("x", "y", "lid"), ["x", "y"])
    cell = F.struct("cx", "cy").alias("cell")
    cell_min = members.join(core.select("lid", cell), "lid").groupBy("cell").agg(F.min("id").alias("m"))
    comp_cells = connected_min_value(cell_edges, cell_min)
    core_lab = core.select("lid", cell).join(comp_cells, "cell").select("lid", "label")
    # border locations, each as a cell of its own at its place: the smallest label of the core cells within reach
    nonc = loc.join(core.select("lid"), "lid", "left_anti")
    border = _attached(nonc, core, comp_cells, eps)
    loc_lab = core_lab.unionByName(border)
    codes = with_position(loc_lab.select("label").distinct(), "label", "cluster")
    out = members.join(loc_lab, "lid", "left").join(codes, "label", "left") \
                 .select(F.col("id").alias(id_col), F.coalesce(F.col("cluster"), F.lit(-1)).cast("bigint").alias("label"))
    size = out.groupBy("label").agg(F.count(F.lit(1)).alias("cluster_size"))
    return out.join(size, "label").select(id_col, "label", "cluster_size")


def _attached(nonc: DataFrame, core: DataFrame, comp_cells: DataFrame, eps: float) -> DataFrame:
    """(lid, label) of the non-core locations that have a core point within ``eps``."""
    reps = cut_lineage(outermost(core, ["cx", "cy"]).select(F.struct("cx", "cy").alias("cell"), "reps", *[F.col(c).alias("b" + c) for c in ("x0", "x1", "y0", "y1")])
                       .join(comp_cells.select("cell", "label"), "cell"), "border_cells")
    around = F.explode(F.array(*[F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")) for dx in range(-2, 3) for dy in range(-2, 3)]))
    met = F.exists("reps", lambda q: _d2(F.col("p"), q) <= eps * eps)
    tried = nonc.select("lid", F.struct("x", "y").alias("p"), around.alias("cell")).join(reps, "cell") \
                .where(_to_box(F.col("p.x"), F.col("p.y"), "b") <= eps * eps * (1 + 1e-9)).withColumn("met", met)
    tried = cut_lineage(tried.select("lid", "p", "cell", "label", "met"), "border_tried")
    points = core.select(F.struct("cx", "cy").alias("cell"), F.struct("x", "y").alias("q"))
    found = tried.where(~F.col("met")).join(points, "cell").where(_d2(F.col("p"), F.col("q")) <= eps * eps).select("lid", "label")
    return tried.where("met").select("lid", "label").union(found).groupBy("lid").agg(F.min("label").alias("label"))


def connected_min_value(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(cell, label): the smallest node value ``m`` in each connected
    component of ``edges`` (a, b) over cells; min propagation plus one jump
    through the current labels per round, until nothing changes."""
    lab = cut_lineage(nodes.select("cell", F.col("m").alias("label")))
    sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    sym = cut_lineage(sym)
    while True:
        nb = sym.join(lab.withColumnRenamed("cell", "b"), "b").groupBy("a").agg(F.min("label").alias("nl"))
        step = lab.join(nb.withColumnRenamed("a", "cell"), "cell", "left") \
                  .select("cell", F.least("label", F.coalesce("nl", "label")).alias("label"), F.col("label").alias("old"))
        # jump: every cell whose old label was L learns the smallest new label
        # reached by any cell that also had L (they are one component)
        low = step.groupBy("old").agg(F.min("label").alias("_low"))
        new = step.join(low.withColumnRenamed("old", "label"), "label", "left") \
                  .select("cell", F.least("label", F.coalesce("_low", "label")).alias("label"), "old")
        new = cut_lineage(new.withColumn("ch", F.col("label") < F.col("old")).drop("old"))
        changed = new.where("ch").limit(1).count()
        lab = new.select("cell", "label")
        if not changed:
            return lab


#: Locations of one tile, compared with each other at once.
TILE = 512


def tiled(loc: DataFrame, size: int = TILE) -> DataFrame:
    """``loc`` (distinct x, y) with ``strip`` and ``tile``: strips of equal counts by x, each cut by y
    into tiles of ``size`` locations, whatever their density; the last tile may have fewer."""
    n = loc.count()
    tiles = -(-n // size)
    per_strip = -(-tiles // max(1, math.isqrt(tiles))) * size
    along = with_position(loc.withColumn("_at", F.struct("x", "y")), "_at", "_p").drop("_at").withColumn("strip", F.floor(F.col("_p") / per_strip))
    across = with_position(along.drop("_p").withColumn("_at", F.struct("strip", "y", "x")), "_at", "_p").drop("_at")
    return across.withColumn("tile", F.floor(F.col("_p") / size)).drop("_p")


def _nearest_of(k: int):
    """Function of places and the locations of a tile: per place the squared distances
    and weights of its ``k`` nearest locations that are nearer than ``bound``, if it has one."""

    def near(places, own):
        own_x, own_y, own_w = (own[c].to_numpy() for c in ("x", "y", "w"))
        x, y = places["x"].to_numpy(), places["y"].to_numpy()
        bound = places["bound"].to_numpy() if "bound" in places.column_names else None
        dists, weights, few = [], [], min(k, len(own_x))
        for s in range(0, len(x), TILE):
            dx, dy = x[s:s + TILE, None] - own_x, y[s:s + TILE, None] - own_y
            d2 = dx * dx + dy * dy
            at = np.argpartition(d2, few - 1, axis=1)[:, :few] if few < len(own_x) else np.tile(np.arange(few), (len(d2), 1))
            d2, w = np.take_along_axis(d2, at, 1), own_w[at]
            kept = np.ones(d2.shape, bool) if bound is None else d2 < bound[s:s + TILE, None]
            dists += [d[m].tolist() for d, m in zip(d2, kept)]
            weights += [v[m].tolist() for v, m in zip(w, kept)]
        near = pa.StructArray.from_arrays([pa.array([v for d in dists for v in d], pa.float64()), pa.array([v for d in weights for v in d], pa.int64())], ["d2", "w"])
        ends = np.cumsum([0, *map(len, dists)]).astype(np.int32)
        return pa.table({"x": x, "y": y, "strip": places["strip"], "tile": places["tile"], "near": pa.ListArray.from_arrays(pa.array(ends), near)})
    return near


_NEAR = "x double, y double, strip bigint, tile bigint, near array<struct<d2: double, w: bigint>>"


def _kth(near, k: int):
    """The squared distance at which the weights of ``near`` reach ``k``, else null."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("d2"))
    step = lambda acc, v: F.struct((acc["n"] + v["w"]).alias("n"), F.when(acc["n"] >= k, acc["d2"]).when(acc["n"] + v["w"] >= k, v["d2"]).alias("d2"))
    return F.aggregate(F.array_sort(near), none, step)["d2"]


def k_distance(pts: DataFrame, k: int = 5, start: float = 0.05, id_col: str = "point_id", x: str = "x",
               y: str = "y", growth: float = 2.0, tile: int = TILE) -> DataFrame:
    """CLU-3: distance to the k-th nearest point, itself included.

    Identical coordinates collapse to one location with a multiplicity (a
    location holding >= k points has distance 0).  Exact at any density: locations are
    cut into tiles of equal counts; the k nearest in its own tile bound a location's
    distance, and it is sent on only to those tiles whose bounding box is nearer than
    that.  Only a location's k nearest of a tile come out, so no pairs are listed, and no
    radius is searched (``start`` and ``growth`` have no effect).  With fewer than k
    points in all, every distance is null; so is that of a point that is not finite."""
    with_library(pts.sparkSession)
    p = pts.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    p = p.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
    loc = cut_lineage(p.where(finite("x") & finite("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")), "kdist_locations")
    loc = cut_lineage(tiled(loc, max(tile, k)), "kdist_tiles")
    near_of = _nearest_of(k)
    own = loc.groupBy("tile").applyInArrow(lambda t: near_of(t, t), _NEAR)
    own = cut_lineage(own.withColumn("bound", _kth(F.col("near"), k)), "kdist_own")
    tiles = loc.groupBy("strip", "tile").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    tiles = cut_lineage(tiles, "kdist_boxes")  # one row a tile
    strips = tiles.groupBy(F.col("strip").alias("to_strip")).agg(F.min("x0").alias("sx0"), F.max("x1").alias("sx1"))
    away = lambda c, lo, hi: F.greatest(F.col(lo) - F.col(c), F.col(c) - F.col(hi), F.lit(0.0))
    open_ = own.select("x", "y", F.col("tile").alias("from"), F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    sent = (open_.join(F.broadcast(strips), away("x", "sx0", "sx1") * away("x", "sx0", "sx1") < F.col("bound"))
            .join(F.broadcast(tiles.withColumnRenamed("strip", "to_strip")), "to_strip")
            .where((F.col("tile") != F.col("from")) & (away("x", "x0", "x1") * away("x", "x0", "x1") + away("y", "y0", "y1") * away("y", "y0", "y1") < F.col("bound")))
            .select("x", "y", F.col("to_strip").alias("strip"), "tile", "bound"))
    found = sent.groupBy("tile").cogroup(loc.groupBy("tile")).applyInArrow(near_of, _NEAR)
    found = found.groupBy("x", "y").agg(F.flatten(F.collect_list("near")).alias("far"))
    near = F.concat("near", F.coalesce("far", F.array().cast("array<struct<d2: double, w: bigint>>")))
    res = own.join(found, ["x", "y"], "left").select("x", "y", F.sqrt(F.when(F.col("far").isNull(), F.col("bound")).otherwise(_kth(near, k))).alias("kdist"))
    return p.join(res, ["x", "y"], "left").select(F.col("id").alias(id_col), "kdist")


def eps_pairs_between(left: DataFrame, right: DataFrame, eps: float, id_col: str, x: str, y: str) -> DataFrame:
    """Pairs (a from left, b from right) within eps via the same grid join."""
    a = left.select(F.col(id_col).alias("a"), F.col(x).alias("ax"), F.col(y).alias("ay"),
                    F.floor(F.col(x) / eps).alias("cx"), F.floor(F.col(y) / eps).alias("cy"))
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    b = (right.select(F.col(id_col).alias("b"), F.col(x).alias("bx"), F.col(y).alias("by"),
                      F.floor(F.col(x) / eps).alias("qx"), F.floor(F.col(y) / eps).alias("qy"))
         .select("*", F.explode(offs).alias("o"))
         .select("b", "bx", "by", (F.col("qx") + F.col("o.dx")).alias("cx"), (F.col("qy") + F.col("o.dy")).alias("cy")))
    d2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    return a.join(b, ["cx", "cy"]).where(d2 <= F.lit(eps * eps)).select("a", "b", F.sqrt(d2).alias("d"))


def kmeans_features(pts: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42, id_col: str = "point_id",
                    prefix: str = "cluster") -> DataFrame:
    """CLU-1: k-means on standardised columns -> label, distance to own
    centre, cluster size; ``pyspark.ml.clustering.KMeans`` (k-means||)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    z = standardize(pts.select(id_col, *cols), cols)
    v = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(z)
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol=prefix).fit(v)
    centers = model.clusterCenters()
    cdf = pts.sparkSession.createDataFrame([(i, *[float(x) for x in c]) for i, c in enumerate(centers)],
                                           [prefix, *[f"_c_{c}" for c in cols]])
    pred = model.transform(v).join(F.broadcast(cdf), prefix)
    dist = F.sqrt(sum((F.col(c) - F.col(f"_c_{c}")) ** 2 for c in cols))
    out = pred.select(id_col, prefix, dist.alias(f"{prefix}_dist"))
    size = out.groupBy(prefix).agg(F.count(F.lit(1)).alias(f"{prefix}_count"))
    return out.join(size, prefix)


def assign_to_centres(pts: DataFrame, centres: list[tuple[float, ...]], cols: Sequence[str], id_col: str = "point_id",
                      prefix: str = "cluster") -> DataFrame:
    """CLU-1 with fixed centres: nearest centre (ties to the lower index),
    Euclidean distance to it, and the cluster size.  The k centres enter
    the plan as literals (k distance expressions per row), so no join."""
    d2 = [sum((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, ctr)) for ctr in centres]
    best = F.lit(0)
    bd = d2[0]
    for i in range(1, len(d2)):
        best = F.when(d2[i] < bd, F.lit(i)).otherwise(best)
        bd = F.least(bd, d2[i])
    out = pts.select(id_col, *cols, best.cast("bigint").alias(prefix), F.sqrt(bd).alias(f"{prefix}_dist"))
    size = out.groupBy(prefix).agg(F.count(F.lit(1)).alias(f"{prefix}_count"))
    return out.join(size, prefix)


# ---------------------------------------------------------------------------
# CLU-1: mini-batch k-means
# ---------------------------------------------------------------------------

def batches_of(pts: DataFrame, cols: Sequence[str], n: int, batch: int, rounds: int, seed: int = 42, id_col: str = "point_id") -> DataFrame:
    """(id, cols, ``_hash``, ``_round``): the rows of each round's batch.  An epoch deals all
    rows into ``ceil(n / batch)`` batches by a hash of their id, another epoch by
    another hash; only the rounds asked for are kept, so at most about ``rounds *
    batch`` rows are, whatever the table."""
    per_epoch = max(1, -(-n // batch))
    epochs = -(-rounds // per_epoch)
    first = hash_unit(id_col, seed)
    turns = F.array(*[F.lit(e * per_epoch).cast("bigint") + hash_unit(id_col, seed + e) % per_epoch for e in range(epochs)])
    drawn = pts.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols], first.alias("_hash"), F.explode(turns).alias("_round"))
    return drawn.where(F.col("_round") < rounds)


def minibatch_centres(pts: DataFrame, cols: Sequence[str], k: int = 5, batch: int = 1000, rounds: int = 100, seed: int = 42,
                      id_col: str = "point_id", tol: float = 0.0) -> list[tuple[float, ...]]:
    """CLU-1: the centres of mini-batch k-means.

    The batches are written once, sorted by round, so a round reads its own rows only:
    one aggregation of sums and counts by nearest centre, k rows to the driver.  A
    centre moves to the mean of all rows it has ever been given (its rate is one over
    that count).  The first centres are the k distinct batch rows of smallest hash (then
    id); fewer distinct rows give fewer centres.  Rows with a null or a value that is not
    finite take no part.  Stops early when no centre moved by more than ``tol`` > 0."""
    fine = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        fine = fine & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    pts = pts.where(fine & F.col(id_col).isNotNull())
    drawn = batches_of(pts, cols, pts.count(), batch, rounds, seed, id_col)
    drawn = cut_lineage(drawn.repartitionByRange("_round").sortWithinPartitions("_round"), "kmeans_batches")
    start = drawn.groupBy(*cols).agg(F.min(F.struct("_hash", id_col)).alias("_first")).orderBy("_first").limit(k).collect()
    centres = [tuple(float(r[c]) for c in cols) for r in start]
    given = [0] * len(centres)
    for r in range(rounds if centres else 0):
        own = nearest_centre(drawn.where(F.col("_round") == r), centres, cols)
        sums = own.groupBy("_near").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)]).collect()  # k rows
        moved = 0.0
        for s in sums:
            j = s["_near"]
            given[j] += s["n"]
            new = tuple(a + (s[f"s{i}"] - s["n"] * a) / given[j] for i, a in enumerate(centres[j]))
            moved = max(moved, sum((a - b) ** 2 for a, b in zip(new, centres[j])) ** 0.5)
            centres[j] = new
        if tol > 0 and moved <= tol:
            break
    return centres


def nearest_centre(pts: DataFrame, centres: list[tuple[float, ...]], cols: Sequence[str]) -> DataFrame:
    """``pts`` with ``_near``, the index of the nearest centre (ties to the lower)."""
    d2 = [sum((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, ctr)) for ctr in centres]
    return pts.withColumn("_near", F.array_position(F.array(*d2), F.array_min(F.array(*d2))).cast("int") - 1)


def minibatch_kmeans(pts: DataFrame, cols: Sequence[str], k: int = 5, batch: int = 1000, rounds: int = 100, seed: int = 42,
                     id_col: str = "point_id", prefix: str = "cluster") -> DataFrame:
    """CLU-1 as in the reference: standardised columns, mini-batch centres, then label,
    distance to the own centre and cluster size of every row."""
    z = standardize(pts.select(id_col, *cols), cols)
    return assign_to_centres(z, minibatch_centres(z, cols, k, batch, rounds, seed, id_col), cols, id_col, prefix).drop(*cols)
