"""Feature-selection queries (2.15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import select as sel
from ..operators.model import forward_selection, recursive_elimination
from ..sources import views
from ..sources.tables import table
from .registry import query
from .sqltext import with_views

NUMS = ["area", "bal", "built_year", "contract_day", "lon", "lat"]


def _u(parts):
    return "\nUNION ALL\n".join(parts)


@query("sel_variance", "SEL-1", with_views(_u([
    f"SELECT '{c}' AS column, round(var_pop(CAST({c} AS DOUBLE)), 6) AS variance, var_pop(CAST({c} AS DOUBLE)) > 0.1 AS keep "
    f"FROM trades" for c in ["area", "bal", "contract_day", "lat", "mostly_null"]]), "trades"))
def q_variance(spark, sf):
    v = sel.variance_filter(views.trades(spark, sf), ["area", "bal", "contract_day", "lat", "mostly_null"])
    return v.select("column", F.round("variance", 6).alias("variance"), "keep")


SEL2 = ["area", "target", "bal", "built_year", "contract_day"]


def _corr_filter_sql():
    pairs = [f"SELECT '{b}' AS column, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) AS ar FROM trades"
             for i, a in enumerate(SEL2) for b in SEL2[i + 1:]]
    pos = " UNION ALL ".join(f"SELECT '{c}' AS column, {i} AS pos" for i, c in enumerate(SEL2))
    return with_views(f"""
, p AS ({_u(pairs)}), pos AS ({pos})
SELECT pos.column, pos.pos, coalesce(sum(CASE WHEN ar <= 0.8 THEN 1 ELSE 0 END), 0) > 0 AS keep_ref,
       coalesce(sum(CASE WHEN ar > 0.8 THEN 1 ELSE 0 END), 0) = 0 AS keep_fixed
FROM pos LEFT JOIN p ON pos.column = p.column GROUP BY pos.column, pos.pos
""", "trades")


@query("sel_correlation_filter", "SEL-2", _corr_filter_sql())
def q_corr_filter(spark, sf):
    t = views.trades(spark, sf).withColumn("target", F.col("area") * 4321.0 + F.col("bal") / 1000.0)
    return sel.correlation_filter(t, SEL2, 0.8)


def _vif3_sql(src, cols, centered):
    a, b, c = cols
    if centered:
        r = {(x, y): f"corr({x}, {y})" for x, y in [(a, b), (a, c), (b, c)]}
    else:
        r = {(x, y): f"sum({x} * {y}) / sqrt(sum({x} * {x}) * sum({y} * {y}))" for x, y in [(a, b), (a, c), (b, c)]}
    r12, r13, r23 = r[(a, b)], r[(a, c)], r[(b, c)]
    det = f"(1 + 2 * ({r12}) * ({r13}) * ({r23}) - pow({r12}, 2) - pow({r13}, 2) - pow({r23}, 2))"
    parts = []
    for col, other in ((a, r23), (b, r13), (c, r12)):
        v = f"(1 - pow({other}, 2)) / {det}"
        flag = f"{v} > 10" if centered else f"{v} >= 10"
        parts.append(f"SELECT '{col}' AS column, round({v}, 4) AS vif, {flag} AS flagged FROM {src}")
    return _u(parts)


VIF = ["area", "target", "bal"]


def _filled(cols, src):
    """``src`` with the nulls of ``cols`` filled with the column's median."""
    fills = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {src})) AS {c}" for c in cols)
    return f"SELECT {fills} FROM {src}"


VIF_U = ["contract_day", "lat", "lon"]


@query("sel_vif_intercept", "SEL-3", with_views(
    ", r AS (SELECT area, area * 100e0 + bal / 100e0 + contract_day * 5e0 AS target, bal FROM trades),\n"
    + "s AS (" + _filled(VIF, "r") + ")\n" + _vif3_sql("s", VIF, True), "trades"))
def q_vif(spark, sf):
    t = views.trades(spark, sf) \
             .select("area", (F.col("area") * 100.0 + F.col("bal") / 100.0 + F.col("contract_day") * 5.0).alias("target"), "bal")
    return sel.vif(t, VIF, centered=True, digits=4)


@query("sel_vif_uncentered", "SEL-4", with_views(
    ", r AS (SELECT CAST(contract_day AS DOUBLE) AS contract_day, lat, lon FROM trades),\n"
    + "s AS (" + _filled(VIF_U, "r") + ")\n" + _vif3_sql("s", VIF_U, False), "trades"))
def q_vif_u(spark, sf):
    t = views.trades(spark, sf).select("contract_day", "lat", "lon")
    return sel.vif(t, VIF_U, centered=False, digits=4)


def _cramer_sql(pairs, src="trades"):
    parts = []
    for a, b in pairs:
        ct = (f"(SELECT coalesce(CAST({a} AS VARCHAR), 'missing') AS v1, coalesce(CAST({b} AS VARCHAR), 'missing') AS v2, "
              f"count(*) AS o FROM {src} GROUP BY 1, 2)")
        q = f"""(WITH ct AS {ct},
 r AS (SELECT v1, sum(o) AS r FROM ct GROUP BY v1), c AS (SELECT v2, sum(o) AS c FROM ct GROUP BY v2),
 n AS (SELECT sum(o) AS n, (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM c) AS nc FROM ct),
 cells AS (SELECT r.v1, c.v2, r.r * c.c / n.n AS e, coalesce(ct.o, 0) AS o FROM r CROSS JOIN c CROSS JOIN n
           LEFT JOIN ct ON ct.v1 = r.v1 AND ct.v2 = c.v2),
 x AS (SELECT CASE WHEN (SELECT nr FROM n) = 2 AND (SELECT nc FROM n) = 2
                   THEN sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) ELSE sum(pow(o - e, 2) / e) END AS chi2 FROM cells),
 z AS (SELECT chi2 / n AS phi2, nr, nc, n FROM x, n),
 w AS (SELECT greatest(0, phi2 - (nc - 1) * (nr - 1) / (n - 1)) AS p2c, nr - pow(nr - 1, 2) / (n - 1) AS rc,
              nc - pow(nc - 1, 2) / (n - 1) AS kc, nr, nc FROM z)
 SELECT '{a}' AS c1, '{b}' AS c2,
        CASE WHEN nr < 2 OR nc < 2 OR least(kc - 1, rc - 1) <= 0 THEN 0e0 ELSE round(sqrt(p2c / least(kc - 1, rc - 1)), 6) END AS v,
        CASE WHEN nr < 2 OR nc < 2 OR least(kc - 1, rc - 1) <= 0 THEN false ELSE sqrt(p2c / least(kc - 1, rc - 1)) > 0.7 END AS drop_c2
 FROM w)"""
        parts.append(f"SELECT * FROM {q}")
    return _u(parts)


CRAMER_PAIRS = [("district", "hood"), ("district", "heating"), ("hood", "deal_type"), ("heating", "deal_type"),
                ("district", "region"), ("is_core", "is_test")]


@query("sel_cramers_v", "SEL-5", with_views(
    ", t2 AS (SELECT *, split_part(addr, ' ', 1) AS region, CAST(row_id % 3 = 0 AS INTEGER) AS is_core FROM trades)\n"
    + _cramer_sql(CRAMER_PAIRS, "t2"), "trades"))
def q_cramer(spark, sf):
    t = views.trades(spark, sf).withColumn("region", F.split("addr", " ").getItem(0)) \
             .withColumn("is_core", (F.col("row_id") % 3 == 0).cast("int"))
    return sel.cramers_table(t, CRAMER_PAIRS, 0.7)


@query("sel_yates_2x2", "SEL-5", """
SELECT round(sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e), 6) AS chi2 FROM (
  SELECT r.v1, c.v2, r.r * c.c / n.n AS e, coalesce(ct.o, 0) AS o
  FROM (SELECT l_linestatus AS v1, sum(1) AS r FROM lineitem GROUP BY 1) r
  CROSS JOIN (SELECT CAST(l_quantity > 25 AS VARCHAR) AS v2, sum(1) AS c FROM lineitem GROUP BY 1) c
  CROSS JOIN (SELECT count(*) AS n FROM lineitem) n
  LEFT JOIN (SELECT l_linestatus AS v1, CAST(l_quantity > 25 AS VARCHAR) AS v2, count(*) AS o FROM lineitem GROUP BY 1, 2) ct
    ON ct.v1 = r.v1 AND ct.v2 = c.v2)
""")
def q_yates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_quantity") > 25).cast("string").alias("big"))
    plain = sel.cramers_table(li, [("l_linestatus", "big")], corrected=False, digits=16).select("v")
    return plain.select(F.round(F.col("v") * F.col("v") * li.count(), 6).alias("chi2"))  # a 2 x 2 table: chi2 = n * V^2


@query("sel_k_best_f", "SEL-7", with_views(f"""
SELECT "column", round(f, 4) AS f FROM ({_u([
    f"SELECT '{c}' AS column, pow(corr(CAST({c} AS DOUBLE), target), 2) / (1 - pow(corr(CAST({c} AS DOUBLE), target), 2)) "
    f"* (count(*) FILTER (WHERE {c} IS NOT NULL) - 2) AS f FROM trades" for c in ["mix", "bal", "built_year", "contract_day", "lat"]])})
ORDER BY f DESC, "column" LIMIT 3
""", "trades").replace("FROM trades", "FROM (SELECT *, area + bal / 500e0 AS mix FROM trades)"))
def q_kbest(spark, sf):
    t = views.trades(spark, sf).withColumn("mix", F.col("area") + F.col("bal") / F.lit(500.0))
    f = sel.f_regression(t, ["mix", "bal", "built_year", "contract_day", "lat"], "target")
    return sel.k_best(f, 3, "f").select("column", F.round("f", 4).alias("f"))


@query("sel_target_corr", "SEL-10", with_views(f"""
SELECT "column", round(r, 6) AS r FROM ({_u([f"SELECT '{c}' AS column, corr(CAST({c} AS DOUBLE), target) AS r FROM trades"
                                             for c in ["area", "bal", "built_year", "contract_day", "lat"]])})
WHERE abs(r) > 0.01
""", "trades"))
def q_target_corr(spark, sf):
    t = views.trades(spark, sf)
    return sel.select_by_target_corr(t, ["area", "bal", "built_year", "contract_day", "lat"], "target", 0.01) \
              .select("column", F.round("r", 6).alias("r"))


@query("sel_cramers_drop", "SEL-6", with_views(
    ", t2 AS (SELECT *, split_part(addr, ' ', 1) AS region, CAST(row_id % 3 = 0 AS INTEGER) AS is_core FROM trades),\n"
    + "p AS (" + _cramer_sql(CRAMER_PAIRS, "t2") + """),
s AS (SELECT c1, c2, v FROM p WHERE v > 0.02),
e AS (SELECT c1 AS col, v FROM s UNION ALL SELECT c2, v FROM s),
sc AS (SELECT col, sum(v) AS score FROM e GROUP BY 1),
d AS (SELECT DISTINCT CASE WHEN a.score > b.score OR (a.score = b.score AND s.c1 > s.c2) THEN s.c1 ELSE s.c2 END AS col
      FROM s JOIN sc a ON a.col = s.c1 JOIN sc b ON b.col = s.c2)
SELECT sc.col AS "column", round(score, 5) AS score, d.col IS NOT NULL AS dropped FROM sc LEFT JOIN d ON d.col = sc.col
""", "trades"))
def q_cramers_drop(spark, sf):
    t = views.trades(spark, sf).withColumn("region", F.split("addr", " ").getItem(0)) \
             .withColumn("is_core", (F.col("row_id") % 3 == 0).cast("int"))
    got = sel.cramers_drop(sel.cramers_table(t, CRAMER_PAIRS), 0.02)
    return got.select("column", F.round("score", 5).alias("score"), "dropped")


def _mi_sql(cols, num):
    parts = []
    for c in cols:
        x = (f"CAST(least(floor(({c} - lo) / ((hi - lo) / 10e0)), 9) AS VARCHAR)" if c in num else c)
        src = (f"(SELECT d.*, m.lo, m.hi FROM dl d, (SELECT min({c}) AS lo, max({c}) AS hi FROM dl) m)" if c in num else "dl")
        parts.append(f"""SELECT '{c}' AS column, round(sum(o / n * ln(o * n / (nx * ny))), 8) AS mi FROM (
  SELECT o, sum(o) OVER () AS n, sum(o) OVER (PARTITION BY x) AS nx, sum(o) OVER (PARTITION BY y) AS ny FROM (
    SELECT {x} AS x, quality AS y, count(*) AS o FROM {src} s WHERE {c} IS NOT NULL GROUP BY 1, 2))""")
    return _u(parts)


@query("sel_mutual_info", "SEL-8", ", ".join([
    "WITH dl AS (SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"])
    + "\n" + _mi_sql(["n_chars", "lang", "source"], ["n_chars"]))
def q_mi(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source") \
        .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return sel.mutual_info(d, ["n_chars", "lang", "source"], "quality").select("column", F.round("mi", 8).alias("mi"))


def _quantile_bin_sql(c, src):
    """Number of distinct inner quantile edges below the value."""
    edges = f"(SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{', '.join(f'{i / 10}' for i in range(1, 10))}])) FROM {src})"
    return f"len(list_filter({edges}, lambda e: CAST({c} AS DOUBLE) > e))"


def _mi_quantile_sql(features, numeric, src, target):
    parts = []
    for c in features:
        x = _quantile_bin_sql(c, src) if c in numeric else c
        parts.append(f"""SELECT '{c}' AS column, round(sum(o / n * ln(o * n / (nx * ny))), 8) AS mi FROM (
  SELECT o, sum(o) OVER () AS n, sum(o) OVER (PARTITION BY x) AS nx, sum(o) OVER (PARTITION BY y) AS ny FROM (
    SELECT x, y, count(*) AS o FROM (SELECT {x} AS x, {target} AS y FROM {src} WHERE {c} IS NOT NULL) GROUP BY 1, 2))""")
    return _u(parts)


MI_Q = ["area", "bal", "built_year", "contract_day", "lat", "heating", "district"]


@query("sel_mutual_info_quantile", "SEL-8", with_views("\n" + _mi_quantile_sql(MI_Q, MI_Q[:5], "trades", "hood"), "trades"))
def q_mi_quantile(spark, sf):
    t = views.trades(spark, sf).select("hood", *MI_Q)
    return sel.mutual_info(t, MI_Q, "hood", how="quantile").select("column", F.round("mi", 8).alias("mi"))


@query("sel_anova_f", "SEL-9", """
WITH e AS (SELECT value AS x, label AS g FROM embeddings, (SELECT 1) WHERE false),
d AS (SELECT CAST(d.n_chars AS DOUBLE) AS x, l.quality AS g FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT count(*) AS n, avg(x) AS m FROM d),
g AS (SELECT g, count(*) AS ng, avg(x) AS mg, var_pop(x) AS vg FROM d GROUP BY g)
SELECT 'n_chars' AS column, round((sum(ng * pow(mg - m, 2)) / (count(*) - 1)) / (sum(ng * vg) / (max(n) - count(*))), 6) AS f
FROM g, t
""".replace("WITH e AS (SELECT value AS x, label AS g FROM embeddings, (SELECT 1) WHERE false),\n", "WITH "))
def q_anova(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars") \
        .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return sel.anova_f(d, ["n_chars"], "quality").select("column", F.round("f", 6).alias("f"))


def _groups_sql():
    cols = ["area", "area2", "bal", "contract_day"]
    mi = []
    for c in cols:
        mi.append(f"""SELECT '{c}' AS col, sum(o / n * ln(o * n / (nx * ny))) AS mi FROM (
  SELECT o, sum(o) OVER () AS n, sum(o) OVER (PARTITION BY x) AS nx, sum(o) OVER (PARTITION BY y) AS ny FROM (
    SELECT CAST(least(floor(({c} - lo) / ((hi - lo) / 10e0)), 9) AS VARCHAR) AS x, yb AS y, count(*) AS o
    FROM tb, (SELECT min({c}) AS lo, max({c}) AS hi FROM tb) WHERE {c} IS NOT NULL GROUP BY 1, 2))""")
    pairs = [f"SELECT '{a}' AS c1, '{b}' AS c2, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) AS ar FROM s"
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    return with_views(f"""
, s AS (SELECT area, area * 2e0 + contract_day / 1000e0 AS area2, bal, contract_day, target FROM trades),
tb AS (SELECT s.*, least(floor((target - lo) / ((hi - lo) / 10e0)), 9) AS yb FROM s, (SELECT min(target) AS lo, max(target) AS hi FROM s)),
mi AS ({_u(mi)}),
pairs AS ({_u(pairs)}),
g AS (SELECT c2 AS key, c1 AS col FROM pairs WHERE ar > 0.9 UNION SELECT c2, c2 FROM pairs WHERE ar > 0.9),
best AS (SELECT col FROM (SELECT g.key, g.col, row_number() OVER (PARTITION BY g.key ORDER BY round(mi.mi, 10) DESC, g.col DESC) AS rn
                          FROM g JOIN mi ON g.col = mi.col) WHERE rn = 1)
SELECT DISTINCT col AS "column" FROM (SELECT col FROM best UNION ALL SELECT col FROM mi WHERE col NOT IN (SELECT col FROM g))
""", "trades")


@query("sel_correlated_groups", "SEL-11", _groups_sql())
def q_groups(spark, sf):
    t = views.trades(spark, sf).select("area", "target", "bal", "contract_day") \
             .withColumn("area2", F.col("area") * 2.0 + F.col("contract_day") / 1000.0)
    return sel.correlated_groups(t, ["area", "area2", "bal", "contract_day"], "target")


@query("sel_forward_selection", "SEL-13")
def q_sfs(spark, sf):
    t = views.trades(spark, sf).where("is_test = 0").select("row_id", "target", "area", "bal", "built_year",
                                                           "contract_day", "lat")
    rows = forward_selection(t, ["area", "bal", "built_year", "contract_day", "lat"], "target", 3)
    return spark.createDataFrame(rows, "k int, added string, cv_rmse double, cv_std double")


@query("sel_recursive_elimination", "SEL-12")
def q_rfe(spark, sf):
    t = views.trades(spark, sf).where("is_test = 0").select("row_id", "target", "area", "bal", "built_year",
                                                           "contract_day", "lat")
    rows = recursive_elimination(t, ["area", "bal", "built_year", "contract_day", "lat"], "target", 3)
    return spark.createDataFrame(rows, "n_features int, dropped string, cv_rmse double, cv_std double")


# ---------------------------------------------------------------------------
# SET-3: feature lists as DataFrames (common / union / rest of two methods)
# ---------------------------------------------------------------------------

def _var_sql():
    return _u([f"SELECT '{c}' AS feature FROM trades HAVING var_pop(CAST({c} AS DOUBLE)) > 0.1"
               for c in ["area", "bal", "contract_day", "lat", "mostly_null"]])


def _kbest_sql():
    return (f"""SELECT feature FROM ({_u([
        f"SELECT '{c}' AS feature, pow(corr(CAST({c} AS DOUBLE), target), 2) / (1 - pow(corr(CAST({c} AS DOUBLE), target), 2)) "
        f"* (count(*) FILTER (WHERE {c} IS NOT NULL) - 2) AS f FROM (SELECT *, area + bal / 500e0 AS mix FROM trades)"
        for c in ["mix", "bal", "built_year", "contract_day", "lat"]])}) ORDER BY f DESC, feature LIMIT 3""")


@query("set_feature_lists", "SET-3", with_views(f"""
, a AS ({_var_sql()}), b AS ({_kbest_sql()})
SELECT 'common' AS "set", feature FROM (SELECT feature FROM a INTERSECT SELECT feature FROM b)
UNION ALL SELECT 'union', feature FROM (SELECT feature FROM a UNION SELECT feature FROM b)
UNION ALL SELECT 'rest', feature FROM (SELECT feature FROM a EXCEPT SELECT feature FROM b)
""", "trades"))
def q_feature_sets(spark, sf):
    t = views.trades(spark, sf)
    a = sel.variance_filter(t, ["area", "bal", "contract_day", "lat", "mostly_null"]).where("keep") \
           .select(F.col("column").alias("feature"))
    tm = t.withColumn("mix", F.col("area") + F.col("bal") / F.lit(500.0))
    b = sel.k_best(sel.f_regression(tm, ["mix", "bal", "built_year", "contract_day", "lat"], "target"), 3, "f") \
           .select(F.col("column").alias("feature"))
    return (a.intersect(b).select(F.lit("common").alias("set"), "feature")
            .unionByName(a.union(b).distinct().select(F.lit("union").alias("set"), "feature"))
            .unionByName(a.subtract(b).select(F.lit("rest").alias("set"), "feature")))
