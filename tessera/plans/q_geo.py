"""Geospatial queries (2.13): grid equi-joins, exact nearest, zones, box report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo
from ..sources import views
from .registry import query
from .sqltext import with_views

HAV = ("2 * 6371.0e0 * atan2(sqrt(pow(sin((radians(p.lat) - radians(t.lat)) / 2), 2) + cos(radians(t.lat)) * cos(radians(p.lat)) "
       "* pow(sin((radians(p.lon) - radians(t.lon)) / 2), 2)), sqrt(1 - (pow(sin((radians(p.lat) - radians(t.lat)) / 2), 2) "
       "+ cos(radians(t.lat)) * cos(radians(p.lat)) * pow(sin((radians(p.lon) - radians(t.lon)) / 2), 2))))")


def transport_sql(prefix, poi_view):
    return f"""
{prefix}_loc AS (SELECT DISTINCT lon, lat FROM trades WHERE lon IS NOT NULL AND lat IS NOT NULL),
{prefix}_d AS (SELECT t.lon, t.lat, {HAV} * 1000e0 AS m FROM {prefix}_loc t, {poi_view} p),
{prefix}_f AS (SELECT lon, lat,
    count(*) FILTER (WHERE m <= 200) AS {prefix}_station_area_count,
    count(*) FILTER (WHERE m <= 500) AS {prefix}_direct_influence_count,
    count(*) FILTER (WHERE m <= 1500) AS {prefix}_indirect_influence_count,
    min(m) AS {prefix}_shortest_distance FROM {prefix}_d GROUP BY lon, lat)"""


def _zone(prefix):
    d = f"{prefix}_shortest_distance"
    return (f"CAST(CASE WHEN {d} IS NULL THEN NULL WHEN {d} <= 200 THEN 1 WHEN {d} <= 500 THEN 2 "
            f"WHEN {d} <= 1500 THEN 3 ELSE 0 END AS INTEGER) AS {prefix}_zone_type")


def _cols(prefix):
    return [f"{prefix}_station_area_count", f"{prefix}_direct_influence_count", f"{prefix}_indirect_influence_count"]


@query("geo_subway_features", ("GEO-1", "GEO-3", "GEO-4", "GEO-5", "GEO-6", "JOI-5"), with_views(f"""
, {transport_sql('subway', 'pois')}
SELECT t.row_id, {', '.join('f.' + c for c in _cols('subway'))},
       round(f.subway_shortest_distance, 3) AS subway_shortest_distance, {_zone('f.subway')}
FROM trades t LEFT JOIN subway_f f ON t.lon = f.lon AND t.lat = f.lat
""", "trades", "pois").replace("f.subway_zone_type", "subway_zone_type"))
def q_subway(spark, sf):
    t = views.trades(spark, sf).select("row_id", "lon", "lat")
    f = geo.transport_features(t, views.pois(spark, sf), "subway")
    return f.select("row_id", *_cols("subway"), F.round("subway_shortest_distance", 3).alias("subway_shortest_distance"),
                    "subway_zone_type")


@query("geo_transport_step", "GEO-9", with_views(f"""
, {transport_sql('subway', 'pois')}, {transport_sql('bus', 'bus_stops')}
SELECT t.row_id, {', '.join('s.' + c for c in _cols('subway'))}, round(s.subway_shortest_distance, 3) AS subway_shortest_distance,
       {_zone('s.subway')}, {', '.join('b.' + c for c in _cols('bus'))}, round(b.bus_shortest_distance, 3) AS bus_shortest_distance,
       {_zone('b.bus')}
FROM trades t LEFT JOIN subway_f s ON t.lon = s.lon AND t.lat = s.lat LEFT JOIN bus_f b ON t.lon = b.lon AND t.lat = b.lat
""", "trades", "pois", "bus_stops").replace("s.subway_zone_type", "subway_zone_type").replace("b.bus_zone_type", "bus_zone_type"))
def q_transport(spark, sf):
    t = views.trades(spark, sf).select("row_id", "lon", "lat")
    f = geo.transport_features(t, views.pois(spark, sf), "subway")
    f = geo.transport_features(f, views.bus_stops(spark, sf), "bus")
    return f.select("row_id", *_cols("subway"), F.round("subway_shortest_distance", 3).alias("subway_shortest_distance"),
                    "subway_zone_type", *_cols("bus"), F.round("bus_shortest_distance", 3).alias("bus_shortest_distance"),
                    "bus_zone_type")


@query("geo_box_report", "GEO-7", with_views("""
SELECT min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat,
       count(*) FILTER (WHERE lon BETWEEN 126.5 AND 127.5 AND lat BETWEEN 37.0 AND 38.0) AS n_valid,
       count(*) FILTER (WHERE lon IS NOT NULL AND lat IS NOT NULL AND NOT (lon BETWEEN 126.5 AND 127.5 AND lat BETWEEN 37.0 AND 38.0)) AS n_outside
FROM trades
""", "trades"))
def q_box(spark, sf):
    return geo.box_report(views.trades(spark, sf))


def _sums_sql(distance):
    return with_views(f"""
, loc AS (SELECT DISTINCT lon, lat FROM trades WHERE lon IS NOT NULL AND lat IS NOT NULL),
s AS (SELECT t.lon, t.lat, sum({distance}) AS d FROM loc t, pois p GROUP BY 1, 2),
b AS (SELECT t.lon, t.lat, sum({distance}) AS d FROM loc t, bus_stops p GROUP BY 1, 2)
SELECT t.row_id, round(s.d, 6) AS distance_sum_subway, round(b.d, 6) AS distance_sum_bus
FROM trades t LEFT JOIN s ON t.lon = s.lon AND t.lat = s.lat LEFT JOIN b ON t.lon = b.lon AND t.lat = b.lat
""", "trades", "pois", "bus_stops")


def _sums(spark, sf, metric):
    t = views.trades(spark, sf).select("row_id", "lon", "lat")
    t = geo.distance_sums(t, views.pois(spark, sf), "distance_sum_subway", metric=metric)
    t = geo.distance_sums(t, views.bus_stops(spark, sf), "distance_sum_bus", metric=metric)
    return t.select("row_id", *[F.round(c, 6).alias(c) for c in ("distance_sum_subway", "distance_sum_bus")])


@query("geo_distance_sums", ("GEO-8", "JOI-5"), _sums_sql("sqrt(pow(t.lon - p.lon, 2) + pow(t.lat - p.lat, 2))"))
def q_distance_sums(spark, sf):
    return _sums(spark, sf, "plane")


@query("geo_distance_sums_km", "GEO-8", _sums_sql(HAV))
def q_distance_sums_km(spark, sf):
    return _sums(spark, sf, "km")
