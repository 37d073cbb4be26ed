"""Null handling (2.5) and group-spread window queries (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nulls
from ..sources import views
from .registry import query
from .sqltext import with_views

GROUPS = ["district", "hood", "complex"]


def hfill_sql(num, txt, groups=GROUPS, src="trades", out_cols=("row_id",)):
    """Oracle text for the hierarchical fill: one CTE per level, windows for
    means, counted modes (ties to the smallest) joined back, then the global
    mean / mode, then 'Unknown'."""
    ctes, prev = [], src
    cols_all = [*out_cols, *groups, *num, *txt]
    levels = [groups[:k] for k in range(len(groups), 0, -1)]
    for li, lv in enumerate(levels):
        part = ", ".join(lv)
        name = f"f{li}"
        sel = []
        mode_joins = []
        for c in cols_all:
            if c in num:
                sel.append(f"coalesce(s.{c}, avg(s.{c}) OVER (PARTITION BY {', '.join('s.' + g for g in lv)})) AS {c}")
            elif c in txt:
                sel.append(f"coalesce(s.{c}, m_{c}.mv) AS {c}")
                ctes.append(f"m{li}_{c} AS (SELECT {part}, {c} AS mv FROM (SELECT {part}, {c}, row_number() OVER "
                            f"(PARTITION BY {part} ORDER BY count(*) DESC, {c}) AS rn FROM {prev} WHERE {c} IS NOT NULL "
                            f"GROUP BY {part}, {c}) WHERE rn = 1)")
                on = " AND ".join(f"s.{g} = m_{c}.{g}" for g in lv)
                mode_joins.append(f"LEFT JOIN m{li}_{c} m_{c} ON {on}")
            else:
                sel.append(f"s.{c}")
        ctes.append(f"{name} AS (SELECT {', '.join(sel)} FROM {prev} s {' '.join(mode_joins)})")
        prev = name
    sel = []
    for c in cols_all:
        if c in num:
            sel.append(f"coalesce({c}, avg({c}) OVER ()) AS {c}")
        elif c in txt:
            sel.append(f"coalesce({c}, (SELECT {c} FROM {prev} WHERE {c} IS NOT NULL GROUP BY {c} "
                       f"ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown') AS {c}")
        else:
            sel.append(c)
    ctes.append(f"filled AS (SELECT {', '.join(sel)} FROM {prev})")
    return ", " + ",\n".join(ctes)


@query("nul_sentinels_to_null", "NUL-1", with_views("""
SELECT row_id, CASE WHEN deal_type IN (' ', '-') THEN NULL ELSE deal_type END AS deal_type FROM trades
""", "trades"))
def q_sentinels(spark, sf):
    t = views.trades(spark, sf).select("row_id", "deal_type")
    return nulls.sentinels_to_null(t, ["deal_type"])


@query("nul_drop_sparse_columns", "NUL-2", with_views("""
SELECT * EXCLUDE (mostly_null) FROM trades
""", "trades"))
def q_drop_sparse(spark, sf):
    return nulls.drop_sparse_columns(views.trades(spark, sf), 0.9)


@query("nul_interpolate", ("NUL-3", "WIN-2"), with_views("""
, p AS (SELECT row_id, area, heating, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM trades),
k AS (SELECT *,
  last_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(area IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(area IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p)
SELECT row_id,
       round(CASE WHEN area IS NOT NULL THEN area WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                  ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS area,
       coalesce(heating, 'NULL') AS heating
FROM k
""", "trades"))
def q_interpolate(spark, sf):
    t = views.trades(spark, sf).select("row_id", "area", "heating")
    f = nulls.interpolate(t, ["area"], "row_id", text_cols=["heating"])
    return f.select("row_id", F.round("area", 6).alias("area"), "heating")


@query("nul_hierarchical_fill", "NUL-4", with_views(hfill_sql(["area"], ["heating"]) + """
SELECT row_id, round(area, 6) AS area, heating FROM filled
""", "trades"))
def q_hfill(spark, sf):
    t = views.trades(spark, sf).select("row_id", *GROUPS, "area", "heating")
    f = nulls.hierarchical_fill(t, ["area"], ["heating"], GROUPS)
    return f.select("row_id", F.round("area", 6).alias("area"), "heating")


@query("nul_strategy_median", "NUL-5", with_views("""
SELECT row_id, round(coalesce(area, (SELECT quantile_cont(area, 0.5) FROM trades)), 6) AS area,
       coalesce(CAST(built_year AS DOUBLE), (SELECT quantile_cont(built_year, 0.5) FROM trades)) AS built_year
FROM trades
""", "trades"))
def q_median_fill(spark, sf):
    t = views.trades(spark, sf).select("row_id", "area", "built_year")
    f = nulls.fill_by_strategy(t, ["area", "built_year"], "median")
    return f.select("row_id", F.round("area", 6).alias("area"), "built_year")


@query("nul_strategy_mode_unknown", ("NUL-5", "NUL-6"), with_views("""
SELECT row_id,
       coalesce(heating, (SELECT heating FROM trades WHERE heating IS NOT NULL GROUP BY heating ORDER BY count(*) DESC, heating LIMIT 1)) AS heating,
       coalesce(CASE WHEN deal_type IN (' ', '-') THEN NULL ELSE deal_type END, 'Unknown') AS deal_type,
       round(coalesce(lon, (SELECT avg(lon) FROM trades)), 8) AS lon
FROM trades
""", "trades"))
def q_mode_fill(spark, sf):
    t = views.trades(spark, sf).select("row_id", "heating", "deal_type", "lon")
    f = nulls.fill_by_strategy(t, ["heating"], "most_frequent")
    f = nulls.fill_unknown(nulls.sentinels_to_null(f, ["deal_type"]), ["deal_type"])
    f = nulls.fill_by_strategy(f, ["lon", "heating", "deal_type"], "mean", exclude=["heating", "deal_type"])
    return f.select("row_id", "heating", "deal_type", F.round("lon", 8).alias("lon"))


@query("nul_strategy_drop", "NUL-5", with_views("""
SELECT row_id FROM trades WHERE area IS NOT NULL AND lon IS NOT NULL
""", "trades"))
def q_drop_fill(spark, sf):
    t = views.trades(spark, sf).select("row_id", "area", "lon")
    return nulls.fill_by_strategy(t, ["area", "lon"], "drop").select("row_id")


INF_SQL = "CASE WHEN row_id % 50 = 0 THEN CAST('inf' AS DOUBLE) WHEN row_id % 50 = 1 THEN CAST('-inf' AS DOUBLE) ELSE bal END"


@query("nul_inf_to_null_median", "NUL-7", with_views(f"""
, x AS (SELECT row_id, CASE WHEN isinf(v) OR isnan(v) THEN NULL ELSE v END AS v FROM (SELECT row_id, {INF_SQL} AS v FROM trades))
SELECT row_id, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM x)), 6) AS v FROM x
""", "trades"))
def q_inf(spark, sf):
    t = views.trades(spark, sf)
    x = t.select("row_id", F.when(F.col("row_id") % 50 == 0, F.lit(float("inf")))
                 .when(F.col("row_id") % 50 == 1, F.lit(float("-inf"))).otherwise(F.col("bal")).alias("v"))
    x = nulls.inf_to_null_cols(x, ["v"])
    f = nulls.fill_by_strategy(x, ["v"], "median")
    return f.select("row_id", F.round("v", 6).alias("v"))


@query("nul_typed_fill", "NUL-8", with_views(
    ", s0 AS (SELECT row_id, district, hood, complex, area, built_year, heating, "
    "CASE WHEN deal_type IN (' ', '-') THEN NULL ELSE deal_type END AS deal_type FROM trades)"
    + hfill_sql(["area", "built_year"], ["heating", "deal_type"], src="s0") + """
SELECT row_id, round(area, 6) AS area, round(built_year, 6) AS built_year, heating, deal_type FROM filled
""", "trades"))
def q_typed(spark, sf):
    t = views.trades(spark, sf).select("row_id", *GROUPS, "area", F.col("built_year").cast("double").alias("built_year"),
                                       "heating", "deal_type")
    t = nulls.sentinels_to_null(t, ["deal_type"])
    f = nulls.typed_fill(t, GROUPS)
    return f.select("row_id", F.round("area", 6).alias("area"), F.round("built_year", 6).alias("built_year"),
                    "heating", "deal_type")


@query("win_group_spread", ("WIN-1", "WIN-3"), with_views("""
, m AS (SELECT district, heating AS heating_mode FROM (SELECT district, heating, row_number() OVER
        (PARTITION BY district ORDER BY count(*) DESC, heating) AS rn FROM trades WHERE heating IS NOT NULL
        GROUP BY district, heating) WHERE rn = 1)
SELECT t.row_id, round(avg(t.target) OVER (PARTITION BY t.district), 4) AS target_mean,
       count(*) OVER (PARTITION BY t.district) AS group_size, m.heating_mode
FROM trades t LEFT JOIN m ON t.district = m.district
""", "trades"))
def q_spread(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "target", "heating")
    s = nulls.spread_group_stats(t, ["district"], ["target"], ["heating"], count=True)
    return s.select("row_id", F.round("target_mean", 4).alias("target_mean"), "group_size", "heating_mode")


# ---------------------------------------------------------------------------
# SET-4: table equality (bag difference both ways) and describe of a - b
# ---------------------------------------------------------------------------

def _interp_cte():
    return """
ip AS (SELECT row_id, area, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM trades),
ik AS (SELECT *,
  last_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(area IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(area IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM ip),
ia AS (SELECT row_id, round(CASE WHEN area IS NOT NULL THEN area WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                   ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS area FROM ik)"""


@query("set_table_diff", "SET-4", with_views(hfill_sql(["area"], []) + "," + _interp_cte() + """,
ha AS (SELECT row_id, round(area, 6) AS area FROM filled),
d AS (SELECT ia.area - ha.area AS diff FROM ia JOIN ha ON ia.row_id = ha.row_id)
SELECT (SELECT count(*) FROM (SELECT * FROM ia EXCEPT ALL SELECT * FROM ha)) AS only_left,
       (SELECT count(*) FROM (SELECT * FROM ha EXCEPT ALL SELECT * FROM ia)) AS only_right,
       count(diff) AS n, round(avg(diff), 4) AS mean_diff, round(min(diff), 4) AS min_diff, round(max(diff), 4) AS max_diff
FROM d
""", "trades"))
def q_table_diff(spark, sf):
    from ..operators.combine import table_diff
    t = views.trades(spark, sf).select("row_id", *GROUPS, "area")
    ia = nulls.interpolate(t.select("row_id", "area"), ["area"], "row_id").select("row_id", F.round("area", 6).alias("area"))
    ha = nulls.hierarchical_fill(t, ["area"], [], GROUPS).select("row_id", F.round("area", 6).alias("area"))
    counts = table_diff(ia, ha).first()
    d = ia.alias("a").join(ha.alias("b"), "row_id").select((F.col("a.area") - F.col("b.area")).alias("diff"))
    desc = d.agg(F.count("diff").alias("n"), F.round(F.avg("diff"), 4).alias("mean_diff"),
                 F.round(F.min("diff"), 4).alias("min_diff"), F.round(F.max("diff"), 4).alias("max_diff"))
    # the two bag-difference counts are fitted scalars of the report row
    return desc.select(F.lit(counts["only_left"]).cast("bigint").alias("only_left"),
                       F.lit(counts["only_right"]).cast("bigint").alias("only_right"), "*")


@query("nul_interpolate_by_group", ("NUL-3", "WIN-2"), with_views("""
, p AS (SELECT row_id, district, area, row_number() OVER (PARTITION BY district ORDER BY row_id) - 1 AS pos FROM trades),
k AS (SELECT *,
  last_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY district ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(area IGNORE NULLS) OVER (PARTITION BY district ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN area IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY district ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(area IGNORE NULLS) OVER (PARTITION BY district ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p)
SELECT row_id, round(CASE WHEN area IS NOT NULL THEN area WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                          ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS area
FROM k
""", "trades"))
def q_interpolate_by_group(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "area")
    f = nulls.interpolate_by_group(t, ["area"], "district", "row_id")
    return f.select("row_id", F.round("area", 6).alias("area"))
