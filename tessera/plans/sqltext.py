"""SQL text of the test views, for the DuckDB oracles.

The same text is accepted by Spark SQL and DuckDB; doubles are written
``1e0``-style so both engines divide in DOUBLE.
"""

TRADES = """
SELECT o.o_orderkey AS row_id,
       concat(replace(r.r_name, ' ', '_'), ' ', n.n_name, ' ', c.c_mktsegment) AS addr,
       n.n_name AS district,
       c.c_mktsegment AS hood,
       c.c_name AS complex,
       CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS BIGINT) AS contract_ym,
       CAST(day(o.o_orderdate) AS BIGINT) AS contract_day,
       CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE CAST(1980 + c.c_custkey % 45 AS BIGINT) END AS built_year,
       CASE WHEN o.o_orderkey % 7 = 0 OR c.c_custkey % 9 = 0 OR n.n_nationkey % 8 = 3
            THEN NULL ELSE o.o_totalprice / 4321e0 END AS area,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
            WHEN o.o_orderkey % 30 = 9 THEN 'NEW_A'
            WHEN o.o_orderkey % 30 = 19 THEN 'NEW_B'
            ELSE o.o_orderpriority END AS heating,
       CASE WHEN o.o_orderkey % 13 = 0 THEN ' ' WHEN o.o_orderkey % 13 = 1 THEN '-'
            ELSE o.o_orderstatus END AS deal_type,
       CASE WHEN o.o_orderkey % 20 = 0 THEN 1e0 END AS mostly_null,
       c.c_acctbal AS bal,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL
            WHEN c.c_custkey % 97 = 0 THEN 128.5e0
            ELSE 126.5e0 + (c.c_custkey * 7919 % 10007) / 10007e0 END AS lon,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL
            ELSE 37.0e0 + (c.c_custkey * 104729 % 10009) / 10009e0 END AS lat,
       o.o_totalprice AS target,
       CAST(CASE WHEN o.o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS INT) AS is_test
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

POIS = """
SELECT s_suppkey AS poi_id,
       126.5e0 + ((s_suppkey + 13) * 7919 % 10007) / 10007e0 AS lon,
       37.0e0 + ((s_suppkey + 13) * 104729 % 10009) / 10009e0 AS lat
FROM supplier
"""

LANDMARKS = """
SELECT n_name AS district,
       126.6e0 + n_nationkey / 40e0 AS lead_lon,
       37.2e0 + (n_nationkey * 7 % 25) / 40e0 AS lead_lat
FROM nation WHERE n_nationkey <> 24
"""

ADDRESS_BOOK = """
SELECT c_name AS complex,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 126.5e0 + (c_custkey * 7919 % 10007) / 10007e0 END AS lon,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 37.0e0 + (c_custkey * 104729 % 10009) / 10009e0 END AS lat
FROM customer
"""

SIDE_FEATURES = """
SELECT o_orderkey AS row_id, CAST(year(o_orderdate) AS BIGINT) AS f_year, 0e0 AS bal FROM orders
"""

CLUSTER_POINTS = """
SELECT c_custkey AS point_id,
       (c_nationkey % 5) * 2e0 + c_acctbal / 10000e0 AS x,
       (c_nationkey % 3) * 2e0 + (c_custkey * 7919 % 10007) / 10007e0 AS y
FROM customer
"""

BUS_STOPS = """
SELECT p_partkey AS poi_id, 126.5e0 + (p_partkey * 31 % 10007) / 10007e0 AS lon,
       37.0e0 + (p_partkey * 61 % 10009) / 10009e0 AS lat
FROM part
"""

VIEWS = {
    "bus_stops": BUS_STOPS,
    "trades": TRADES,
    "pois": POIS,
    "landmarks": LANDMARKS,
    "address_book": ADDRESS_BOOK,
    "side_features": SIDE_FEATURES,
    "cluster_points": CLUSTER_POINTS,
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with ``WITH name AS (...)`` for each named view.

    ``body`` may itself start with more CTEs written as ``name AS (...), ...``
    after a leading ``,``; keep it a plain SELECT otherwise.
    """
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = body.strip()
    if body.startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}"
