"""Geospatial features (GEO-1 .. GEO-9) without cross joins.

Distances are haversine (R = 6371 km).  Pairs are never enumerated blindly:
points and POIs are put on a lat/lon grid whose cells are at least the search
radius wide (longitude cells widened by 1/cos of the largest |lat|), each POI
is copied to its 9 neighbouring cells, and an *equi-join on the cell id*
yields exactly the candidates that can be within the radius.  The exact
distance filter follows.  Work is done per distinct location, then joined
back to the rows that share it.  Cells go around the globe, so points on both sides
of the date line meet; a cell that holds very many locations is split into several keys.

Zone counts and near distances are taken from arrays, a cell with the POIs around it
at a time; a location with no POI near is compared with the bounding boxes of tiles of POIs, then
with the tiles that can hold its nearest, so the answer is exact with no cap on candidates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import EARTH_RADIUS_KM, haversine_km
from ..session import with_library
from ..sources.store import cut_lineage
from . import farfield
from .cluster import tiled

KM_PER_DEG = 6371.0 * math.pi / 180.0
# Radius zones in metres (station area, direct, indirect influence).
ZONES = (("station_area", 200), ("direct_influence", 500), ("indirect_influence", 1500))
# The reference's coordinate box (lon 126.5 .. 127.5, lat 37.0 .. 38.0).
BOX = (126.5, 127.5, 37.0, 38.0)


def extent(df: DataFrame) -> dict:
    """min / max lat, lon, max |lat| and the count of located rows, one aggregation."""
    r = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).agg(
        F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"),
        F.max("lon").alias("lon1"), F.max(F.abs("lat")).alias("mal"), F.count(F.lit(1)).alias("n")).first()
    return r.asDict()


def _max_abs_lat(*frames: DataFrame) -> float:
    return max((extent(f)["mal"] or 0.0) for f in frames)


#: Locations of one grid cell that one join key may have; a cell of more is split.
CELL_LOCATIONS = 10_000


def _cells(radius_km: float, max_abs_lat: float) -> tuple[float, int]:
    """Height of a cell in degrees, and the number of cells around the globe, so that
    a cell spans at least the radius; near the poles one cell goes around."""
    cl = radius_km / KM_PER_DEG
    lat_edge = max_abs_lat + cl
    width = radius_km / (KM_PER_DEG * math.cos(math.radians(lat_edge))) if lat_edge < 89.0 else 360.0
    return cl, max(1, int(360.0 / min(360.0, width)))


def stack_pois(pois: DataFrame, poi_id: str = "poi_id") -> DataFrame:
    """Stations stacked at one coordinate become one candidate with a weight
    ``_w`` (a hot coordinate never multiplies the pair join)."""
    return pois.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
               .groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("_w"), F.min(poi_id).alias("_poi"))


def _column(lon: str, around: int):
    """The cell of a longitude: cells go around the globe and meet at 180 degrees."""
    return F.least(F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) / (360.0 / around)), F.lit(around - 1)).cast("bigint")


def _in_cells(locs: DataFrame, stacked: DataFrame, radius_km: float, max_abs_lat: float, loc_id: str, most: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Locations in their cell, stacked POIs in each of the nine cells around theirs, and the columns of a cell's key."""
    cl, around = _cells(radius_km, max_abs_lat)
    p = locs.select(loc_id, "lat", "lon", _column("lon", around).alias("cx"), F.floor(F.col("lat") / cl).alias("cy"))
    beside = sorted({dx % around for dx in (-1, 0, 1)})
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in beside for dy in (-1, 0, 1)])
    q = (stacked.select("_poi", "_w", F.col("lat").alias("plat"), F.col("lon").alias("plon"),
                        _column("lon", around).alias("qx"), F.floor(F.col("lat") / cl).alias("qy"))
         .select("*", F.explode(offs).alias("o"))
         .select("_poi", "_w", "plat", "plon", F.pmod(F.col("qx") + F.col("o.dx"), F.lit(around)).alias("cx"), (F.col("qy") + F.col("o.dy")).alias("cy")))
    keys = ["cx", "cy"]
    dense = (p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
             .select(*keys, F.ceil(F.col("n") / most).cast("int").alias("parts")))
    if not dense.isEmpty():
        dense = cut_lineage(dense, "dense_cells")
        p = p.join(dense, keys, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("lon", "lat"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
        q = q.join(dense, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        keys.append("part")
    return p, q, keys


def candidate_pairs(locs: DataFrame, pois: DataFrame, radius_km: float, max_abs_lat: float,
                    loc_id: str = "loc_id", poi_id: str = "poi_id", most: int = CELL_LOCATIONS) -> DataFrame:
    """(loc_id, poi_id, km) for every pair within ``radius_km`` via a grid equi-join.

    A cell with more than ``most`` locations is split by a hash of the location into
    as many keys as it needs, and the POIs around it go to each of them."""
    p, q, keys = _in_cells(locs, pois if "_w" in pois.columns else stack_pois(pois, poi_id), radius_km, max_abs_lat, loc_id, most)
    j = p.join(q, keys)
    d = haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    return j.select(loc_id, F.col("_poi").alias(poi_id), F.col("_w").alias("w"), d.alias("km")) \
            .where(F.col("km") <= F.lit(radius_km))


def locations(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Distinct valid locations with a stable id (the coordinates themselves)."""
    return (df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
            .select(F.col(lon).alias("lon"), F.col(lat).alias("lat")).distinct()
            .withColumn("loc_id", F.xxhash64("lon", "lat")))


def radius_counts(locs: DataFrame, pois: DataFrame, radii_m: Sequence[int], prefix: str,
                  names: Sequence[str] | None = None, max_abs_lat: float | None = None) -> DataFrame:
    """GEO-4: per location, number of POIs within each radius (cumulative discs)."""
    mal = _max_abs_lat(locs, pois) if max_abs_lat is None else max_abs_lat
    pairs = candidate_pairs(locs, pois, max(radii_m) / 1000.0, mal)
    names = list(names or [str(r) for r in radii_m])
    agg = pairs.groupBy("loc_id").agg(*[F.sum(F.when(F.col("km") * 1000.0 <= F.lit(float(r)), F.col("w")).otherwise(0))
                                        .alias(f"{prefix}_{n}_count") for n, r in zip(names, radii_m)])
    out = locs.join(agg, "loc_id", "left")
    return out.fillna(0, subset=[f"{prefix}_{n}_count" for n in names])


#: Pairs of a location and a POI held at a time.
PAIRS = 65_536


def _on_sphere(lat, lon):
    """Unit vectors, one column each; a chord between two of them grows with the distance."""
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)])


def _km(lat, lon, plat, plon):
    """``haversine_km`` of arrays."""
    la, pla = np.radians(lat), np.radians(plat)
    a = np.sin((pla - la) / 2) ** 2 + np.cos(la) * np.cos(pla) * np.sin((np.radians(plon) - np.radians(lon)) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


def _tiles_near(locs, boxes):
    """The tiles, of all, in which a location's nearest POI can be: their bounding boxes are no farther
    than the nearest of the tiles' first POIs."""
    ids, lat, lon, tile = (t[c].to_numpy() for t, c in ((locs, "loc_id"), (locs, "lat"), (locs, "lon"), (boxes, "tile")))
    here, rep = _on_sphere(lat, lon), _on_sphere(boxes["y"].to_numpy(), boxes["x"].to_numpy())
    low, high = (np.stack([boxes[f"{end}{i}"].to_numpy() for i in range(3)]) for end in ("low", "high"))
    at, to = [], []
    step = max(1, PAIRS // max(1, len(tile)))
    for s in range(0, len(ids) if len(tile) else 0, step):
        own = here[:, s:s + step, None]
        bound = sum((own[i] - rep[i]) ** 2 for i in range(3)).min(axis=1, keepdims=True)
        least = sum(np.maximum(np.maximum(low[i] - own[i], own[i] - high[i]), 0.0) ** 2 for i in range(3))
        a, b = np.nonzero(least <= bound * (1 + 1e-9) + 1e-15)  # slack of bounds only
        at.append(s + a)
        to.append(b)
    at, to = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (at, to))
    return pa.table({"loc_id": ids[at], "lat": lat[at], "lon": lon[at], "tile": tile[to]})


def _nearest_in(locs, pois):
    """The distance of each location to the nearest POI of a tile."""
    ids, lat, lon, plat, plon = (t[c].to_numpy() for t, c in ((locs, "loc_id"), (locs, "lat"), (locs, "lon"), (pois, "y"), (pois, "x")))
    here, there, km = _on_sphere(lat, lon), _on_sphere(plat, plon), np.empty(len(ids))
    step = max(1, PAIRS // len(plat))
    for s in range(0, len(ids), step):
        at = sum((here[i, s:s + step, None] - there[i]) ** 2 for i in range(3)).argmin(axis=1)
        km[s:s + step] = _km(lat[s:s + step], lon[s:s + step], plat[at], plon[at])
    return pa.table({"loc_id": ids, "nearest_km": km})


def nearest(locs: DataFrame, pois: DataFrame, start_km: float = 1.5) -> DataFrame:
    """GEO-5: exact nearest POI distance (km) per location, however far it is.

    The POIs are cut into tiles of equal counts; a location is compared with the tiles' bounding
    boxes (of points on the sphere, so neither poles nor the date line matter), then
    with the POIs of those tiles only that can hold its nearest.  No radius is searched
    (``start_km`` has no effect)."""
    with_library(locs.sparkSession)
    stacked = pois if "_w" in pois.columns else stack_pois(pois)
    finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
    at = stacked.select(F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y")).where(finite("x") & finite("y"))
    tiles = cut_lineage(tiled(at).select("tile", "x", "y"), "poi_tiles")
    la, lo = F.radians("y"), F.radians("x")
    sphere = (F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))
    boxes = tiles.groupBy("tile").agg(F.min(F.struct("x", "y")).alias("p"), *[f(v).alias(f"{end}{i}") for end, f in (("low", F.min), ("high", F.max)) for i, v in enumerate(sphere)])
    boxes = boxes.select("tile", "p.x", "p.y", *[f"{end}{i}" for end in ("low", "high") for i in range(3)])  # one row a tile
    todo = locs.select("loc_id", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    parts = max(1, min(32, -(-todo.count() // 64)), -(-todo.count() // 20_000))
    todo = todo.withColumn("_part", F.pmod(F.xxhash64("lon", "lat"), F.lit(parts)).cast("int")).repartition(parts, "_part")
    sent = boxes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(parts, "_part")
    pairs = todo.groupBy("_part").cogroup(sent.groupBy("_part")).applyInArrow(_tiles_near, "loc_id bigint, lat double, lon double, tile bigint")
    parts = max(32, parts)
    found = pairs.repartition(parts, "tile").groupBy("tile").cogroup(tiles.repartition(parts, "tile").groupBy("tile")).applyInArrow(_nearest_in, "loc_id bigint, nearest_km double")
    return locs.join(found.groupBy("loc_id").agg(F.min("nearest_km").alias("nearest_km")), "loc_id", "left")


def spacing_km(poi_ext: dict) -> float:
    """Typical distance between neighbouring POIs if spread over their box."""
    h = (poi_ext["lat1"] - poi_ext["lat0"]) * KM_PER_DEG
    w = (poi_ext["lon1"] - poi_ext["lon0"]) * KM_PER_DEG * math.cos(math.radians(poi_ext["mal"]))
    return math.sqrt(max(h * w, 1e-9) / max(poi_ext["n"], 1))


def zone_type(nearest_m: str) -> F.Column:
    """GEO-6: 1 within 200 m, 2 within 500 m, 3 within 1500 m, else 0."""
    d = F.col(nearest_m)
    return (F.when(d <= 200, 1).when(d <= 500, 2).when(d <= 1500, 3).otherwise(0)).cast("int")


def _zones_of(radii_m: Sequence[float], radius_km: float):
    """Function of the locations of a cell and the POIs around it: per location with a POI within ``radius_km``
    the weight of those within each radius, and the distance to the nearest.  Squared chords decide; only a pair
    as near to a radius as rounding is long is measured again."""
    edges = [float(r) / 1000.0 for r in radii_m]
    chords = [4.0 * math.sin(min(e / EARTH_RADIUS_KM, math.pi) / 2) ** 2 for e in edges]

    def zones(locs, pois):
        ids, lat, lon = (locs[c].to_numpy() for c in ("loc_id", "lat", "lon"))
        plat, plon, w = (pois[c].to_numpy() for c in ("plat", "plon", "_w"))
        rows = []
        fine = np.isfinite(plat) & np.isfinite(plon)
        plat, plon, w = plat[fine], plon[fine], w[fine]
        if len(w):
            here, there, plain = _on_sphere(lat, lon), _on_sphere(plat, plon), bool((w == 1).all())
            step = max(1, PAIRS // len(w))
            for s in range(0, len(ids), step):
                d2 = sum((here[i, s:s + step, None] - there[i]) ** 2 for i in range(3))
                at = d2.argmin(axis=1)
                km = _km(lat[s:s + step], lon[s:s + step], plat[at], plon[at])
                counts = []
                for edge, chord in zip(edges, chords):
                    within, near = d2 <= chord * (1 - 1e-9) - 1e-15, d2 <= chord * (1 + 1e-9) + 1e-15
                    if np.count_nonzero(near) != np.count_nonzero(within):
                        a, b = np.nonzero(near & ~within)
                        within[a, b] = _km(lat[s + a], lon[s + a], plat[b], plon[b]) * 1000.0 <= edge * 1000.0
                    counts.append(np.count_nonzero(within, axis=1) if plain else within @ w)
                kept = km <= radius_km
                rows.append([ids[s:s + step][kept], *[c[kept] for c in counts], km[kept]])
        names = ["loc_id", *[f"z{i}" for i in range(len(edges))], "nearest_km"]
        got = [np.concatenate([r[i] for r in rows]) if rows else np.empty(0) for i in range(len(names))]
        return pa.table({n: pa.array(g, pa.float64() if n == "nearest_km" else pa.int64()) for n, g in zip(names, got)})
    return zones


def zone_counts(locs: DataFrame, pois: DataFrame, radii_m: Sequence[int], names: Sequence[str], radius_km: float, max_abs_lat: float) -> DataFrame:
    """(loc_id, one count a radius, nearest_km) of the locations that have one of the stacked
    ``pois`` within ``radius_km``; no pair leaves the task that compares a cell with the POIs around it."""
    with_library(locs.sparkSession)
    parts = max(32, -(-locs.count() // 20_000))
    p, q, keys = _in_cells(locs, pois, radius_km, max_abs_lat, "loc_id", CELL_LOCATIONS)
    p, q = p.select(*keys, "loc_id", "lat", "lon"), q.select(*keys, "plat", "plon", "_w")
    schema = "loc_id bigint, " + ", ".join(f"z{i} bigint" for i in range(len(radii_m))) + ", nearest_km double"
    got = p.repartition(parts, *keys).groupBy(*keys).cogroup(q.repartition(parts, *keys).groupBy(*keys)) \
           .applyInArrow(_zones_of(radii_m, radius_km), schema)
    return got.toDF("loc_id", *names, "nearest_km")


def transport_features(df: DataFrame, pois: DataFrame, prefix: str, zones=ZONES, lon: str = "lon",
                       lat: str = "lat") -> DataFrame:
    """GEO-3/4/5/6 for one POI table: zone counts, nearest distance (m) and
    zone type, computed per distinct location and joined back; rows without
    coordinates get nulls (kept, not dropped).

    One grid join at radius r0 = max(largest zone, 2 x typical POI spacing)
    yields the zone counts and, for every location with a POI within r0, its
    exact nearest distance; only the rest go to the search over tiles of POIs."""
    locs = cut_lineage(locations(df, lon, lat))
    pois = cut_lineage(stack_pois(pois))
    pe, le = extent(pois), extent(locs)
    names = [n for n, _ in zones]
    if not pe["n"] or not le["n"]:
        feat = locs.select("loc_id", *[F.lit(0).cast("bigint").alias(f"{prefix}_{n}_count") for n in names],
                           F.lit(None).cast("double").alias("nearest_km"))
    else:
        mal = max(pe["mal"], le["mal"])
        r0 = max(max(r for _, r in zones) / 1000.0, 2.0 * spacing_km(pe))
        agg = cut_lineage(zone_counts(locs, pois, [r for _, r in zones], [f"{prefix}_{n}_count" for n in names], r0, mal), "zone_counts")
        rest = locs.join(agg.select("loc_id"), "loc_id", "left_anti")
        far = nearest(cut_lineage(rest), pois).select("loc_id", "nearest_km")
        feat = locs.select("loc_id").join(agg, "loc_id", "left").fillna(0, subset=[f"{prefix}_{n}_count" for n in names])
        feat = feat.join(far.withColumnRenamed("nearest_km", "_far"), "loc_id", "left") \
                   .withColumn("nearest_km", F.coalesce("nearest_km", "_far")).drop("_far")
    feat = feat.join(locs, "loc_id").select(
        F.col("lon").alias("_flon"), F.col("lat").alias("_flat"),
        *[F.col(f"{prefix}_{n}_count") for n in names],
        (F.col("nearest_km") * 1000.0).alias(f"{prefix}_shortest_distance"))
    feat = feat.withColumn(f"{prefix}_zone_type", zone_type(f"{prefix}_shortest_distance"))
    out = df.join(feat, (df[lon] == feat["_flon"]) & (df[lat] == feat["_flat"]), "left")
    return out.drop("_flon", "_flat")


def box_report(df: DataFrame, box=BOX, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """GEO-7: ranges and the number of points inside the box."""
    inside = F.col(lon).between(box[0], box[1]) & F.col(lat).between(box[2], box[3])
    return df.agg(F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"), F.min(lat).alias("min_lat"),
                  F.max(lat).alias("max_lat"), F.count_if(inside).alias("n_valid"),
                  F.count_if(F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~inside).alias("n_outside"))


# ---------------------------------------------------------------------------
# GEO-8: sum of the distances to all points, by block reduction or by tiles
# ---------------------------------------------------------------------------

def _add_plane(total, x, y, px, py, w):
    """Adds to ``total`` the weighted distances of the places (x, y) to the points, point after point."""
    a, b = np.empty_like(x), np.empty_like(x)
    for qx, qy, n in zip(px.tolist(), py.tolist(), w.tolist()):
        np.subtract(x, qx, out=a)
        np.multiply(a, a, out=a)
        np.subtract(y, qy, out=b)
        np.multiply(b, b, out=b)
        np.add(a, b, out=a)
        np.sqrt(a, out=a)
        np.multiply(a, n, out=a)
        np.add(total, a, out=total)


def _halves(degrees):
    half = np.radians(degrees) / 2
    return np.sin(half), np.cos(half)


def _add_great_circle(total, x, y, px, py, w):
    """As ``_add_plane``, in km: the sines of half differences come from those of the halves."""
    (sx, cx), (sy, cy), at = _halves(x), _halves(y), np.cos(np.radians(y))
    (qsx, qcx), (qsy, qcy), qat = _halves(px), _halves(py), np.cos(np.radians(py))
    a, b, c = np.empty_like(x), np.empty_like(x), np.empty_like(x)
    for s1, c1, s2, c2, k, n in zip(qsx.tolist(), qcx.tolist(), qsy.tolist(), qcy.tolist(), qat.tolist(), w.tolist()):
        np.multiply(sy, c2, out=a)
        np.multiply(cy, s2, out=b)
        np.subtract(a, b, out=a)
        np.multiply(a, a, out=a)
        np.multiply(sx, c1, out=b)
        np.multiply(cx, s1, out=c)
        np.subtract(b, c, out=b)
        np.multiply(b, b, out=b)
        np.multiply(b, at, out=b)
        np.multiply(b, k, out=b)
        np.add(a, b, out=a)
        np.sqrt(a, out=a)
        np.minimum(a, 1.0, out=a)
        np.arcsin(a, out=a)
        np.multiply(a, 2 * EARTH_RADIUS_KM * n, out=a)
        np.add(total, a, out=total)


METRICS = {"plane": _add_plane, "km": _add_great_circle}
#: Places whose columns stay in a core's cache while it goes through the points.
PLACES = 4096


def _folder(metric: str):
    """Function of a part of the places and the blocks of points sent to it: the places
    with the blocks folded into their sums."""
    add = METRICS[metric]

    def fold(places, blocks):
        x, y = places["_x"].to_numpy(), places["_y"].to_numpy()
        total = places["_sum"].to_numpy().copy()
        with np.errstate(all="ignore"):
            for i in np.argsort(blocks["_block"].to_numpy()):
                own = [blocks[c][int(i)].values.to_numpy(zero_copy_only=False) for c in ("px", "py", "w")]
                for s in range(0, len(x), PLACES):
                    add(total[s:s + PLACES], x[s:s + PLACES], y[s:s + PLACES], *own)
        return places.set_column(places.column_names.index("_sum"), "_sum", pa.array(total))
    return fold


#: Pairs of a place and a point up to which each is measured alone.
FEW_PAIRS = 1 << 29
#: Places and points of a tile, and tiles of a part, at most; and parts that there should be.
TILE_ROWS, PART_TILES, PARTS = 16_384, 4, 256


def _by_blocks(locs: DataFrame, spots: DataFrame, found: int, n: int, metric: str, block: int, per_pass: int) -> DataFrame:
    """``locs`` with the distances to ``spots`` added to ``_sum``, point after point: a pass sends
    ``per_pass`` blocks of at most ``block`` points to every part of the places."""
    parts = max(1, min(256, -(-found // 512)), -(-found // 32768))
    locs = locs.withColumn("_part", F.pmod(F.xxhash64("_x", "_y"), F.lit(parts)).cast("int"))
    for first in range(0, n, block * per_pass):
        own = spots.where((F.col("pos") >= first) & (F.col("pos") < first + block * per_pass))
        packed = own.groupBy(F.floor(F.col("pos") / block).alias("_block")).agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y", "w"))).alias("p"))
        sent = packed.select("_block", F.col("p.x").alias("px"), F.col("p.y").alias("py"), F.col("p.w").alias("w"),
                             F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part")).repartition(parts, "_part")
        folded = locs.repartition(parts, "_part").groupBy("_part").cogroup(sent.groupBy("_part")).applyInArrow(_folder(metric), locs.schema)
        locs = cut_lineage(folded, "distance_sums")
    return locs.drop("_part")


def _by_tiles(locs: DataFrame, spots: DataFrame, rows: int, metric: str, tile_rows: int) -> DataFrame:
    """(_x, _y, _sum) of the places: places and points, in the order of a curve that keeps neighbours together, are
    cut into tiles.  A part of the places, one tile or a few in a row, gets the points of the tiles near it
    and of every other tile what stands for its points."""
    from .ordering import with_position
    both = locs.select("_x", "_y", F.lit(None).cast("double").alias("w")).unionByName(spots.select(F.col("x").alias("_x"), F.col("y").alias("_y"), "w"))
    ends = both.agg(*[f(c) for f in (F.min, F.max) for c in ("_x", "_y")]).first()
    curve = both.mapInArrow(farfield.along_curve(ends[:2], ends[2:], "_x", "_y"), "_x double, _y double, w double, at bigint")
    size = max(1, min(tile_rows, max(2048, -(-rows // 128))))
    tiles = -(-rows // size)
    per_part = max(1, min(PART_TILES, -(-tiles // PARTS)))
    dealt = with_position(curve.withColumn("at", F.struct("at", "_x", "_y")), "at", "_pos")
    dealt = cut_lineage(dealt.select("_x", "_y", "w", F.floor(F.col("_pos") / size).alias("_tile")), "distance_tiles")
    parts = -(-tiles // per_part)
    places = dealt.where("w IS NULL").select("_x", "_y", F.floor(F.col("_tile") / per_part).cast("int").alias("_part"))
    points = dealt.where("w IS NOT NULL").select("_tile", F.col("_x").alias("x"), F.col("_y").alias("y"), "w")
    packed = cut_lineage(points.groupBy("_tile").applyInArrow(farfield.packed, farfield.PACKED), "distance_packed")
    bounds = places.groupBy("_part").agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"))
    each = packed.select("_tile", "x0", "x1", "y0", "y1", "n", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    wanted = bounds.groupBy("_part").cogroup(each.groupBy("_part")).applyInArrow(farfield.needed(metric), "_part int, _tile bigint, whole boolean")
    wanted = cut_lineage(wanted, "distance_wanted")
    none = F.lit(None).cast("array<double>")
    whole = packed.join(wanted.where("whole"), "_tile").withColumn("coef", none)
    standing = packed.withColumns({c: none for c in ("px", "py", "w")}).join(wanted.where("NOT whole"), "_tile")
    sent = whole.drop("whole").unionByName(standing.drop("whole"))
    folded = places.repartition(parts, "_part").groupBy("_part").cogroup(sent.repartition(parts, "_part").groupBy("_part")) \
                   .applyInArrow(farfield.folded(metric), "_x double, _y double, _sum double")
    return cut_lineage(folded, "distance_sums")


def distance_sums(df: DataFrame, points: DataFrame, out: str = "distance_sum", x: str = "lon", y: str = "lat",
                  px: str = "lon", py: str = "lat", metric: str = "plane", block: int = 20_000, per_pass: int = 4,
                  few_pairs: int = FEW_PAIRS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """GEO-8: ``df`` with the sum of each row's distances to all ``points``.

    ``metric``: ``plane`` (in the coordinates' own unit, as in the reference) or
    ``km`` (great circle).  Equal points are packed as one with a weight, and the work is done
    per distinct location.

    Up to ``few_pairs`` pairs are measured one by one: the points, in order of their coordinates, are cut
    into blocks of at most ``block``, each one row of arrays; a pass sends ``per_pass`` blocks to every part of
    the locations, which fold them into their running sums as arrays.  There the order of summation, hence the
    result, does not depend on the block size or the parts.  With more pairs, tiles far from a location
    enter its sum through ``farfield``, which is as exact as the sum's own rounding, and only those near it point by point, so
    the time grows with the rows and not with the pairs.  Locations and points that are not finite,
    beyond the poles or out of all proportion are measured one by one in any case.

    Rows without coordinates get null, points without are left out; without points the sum is 0."""
    from .ordering import with_position
    with_library(df.sparkSession)
    spots = (points.where(F.col(px).isNotNull() & F.col(py).isNotNull())
             .groupBy(F.struct(F.col(px).cast("double").alias("x"), F.col(py).cast("double").alias("y")).alias("at"))
             .agg(F.count(F.lit(1)).cast("double").alias("w")))
    ordered = lambda d: cut_lineage(with_position(d, "at", "pos").select("pos", "at.x", "at.y", "w"), "distance_points")
    locs = cut_lineage(df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna().distinct()
                       .withColumn("_sum", F.lit(0.0)), "distance_locations")
    spots, found = ordered(spots), locs.count()
    n = spots.count()
    if found * n <= few_pairs:
        locs = _by_blocks(locs, spots, found, n, metric, block, per_pass)
    else:
        most = (1e4, 90.0) if metric == "km" else (1e100, 1e100)
        plain = lambda a, b: (F.abs(a) <= most[0]) & (F.abs(b) <= most[1])
        odd, odd_spots = locs.where(~plain("_x", "_y")), spots.where(~plain("x", "y"))
        n_odd, n_odd_spots = odd.count(), odd_spots.count()
        tiled_sums = locs.where(plain("_x", "_y"))
        if n > n_odd_spots and found > n_odd:
            tiled_sums = _by_tiles(tiled_sums, spots.where(plain("x", "y")), found - n_odd + n - n_odd_spots, metric, tile_rows)
        if n_odd_spots:
            odd_spots = ordered(odd_spots.select(F.struct("x", "y").alias("at"), "w"))
            tiled_sums = _by_blocks(tiled_sums, odd_spots, found - n_odd, n_odd_spots, metric, block, per_pass)
        locs = tiled_sums.unionByName(_by_blocks(odd, spots, n_odd, n, metric, block, per_pass)) if n_odd else tiled_sums
    locs = locs.withColumnRenamed("_sum", out)
    return df.join(locs, (df[x].cast("double") == locs["_x"]) & (df[y].cast("double") == locs["_y"]), "left").drop("_x", "_y")
