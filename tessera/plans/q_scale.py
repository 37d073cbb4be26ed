"""Scaling / power-transform queries (2.12) and outlier filters (2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import is_holdout
from ..operators import outliers, scale
from ..sources import views
from ..sources.tables import table
from .registry import query
from .sqltext import with_views

HOLD = "(((doc_id % 2147483648) * 2654435761) % 4294967296) % 1000 < 200"


def _psi(method, x="x", lam="lam"):
    if method == "yeo-johnson":
        return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN {lam} = 0 THEN ln({x} + 1) ELSE (pow({x} + 1, {lam}) - 1) / {lam} END) "
                f"ELSE (CASE WHEN {lam} = 2 THEN -ln(-{x} + 1) ELSE -(pow(-{x} + 1, 2 - {lam}) - 1) / (2 - {lam}) END) END")
    return f"CASE WHEN {lam} = 0 THEN ln({x}) ELSE (pow({x}, {lam}) - 1) / {lam} END"


def _jac(method, x="x"):
    return f"sum(sign({x}) * ln(abs({x}) + 1))" if method == "yeo-johnson" else f"sum(ln({x}))"


def best_lambda_sql(src, method, name):
    """CTE text: ``{name}`` = one row (lam) with the best grid lambda for ``src(x)``."""
    return f"""
{name}_g AS (SELECT round(-2 + 0.1 * i, 1) AS lam FROM range(41) t(i)),
{name}_l AS (SELECT g.lam, -count(*) / 2e0 * ln(var_pop({_psi(method, 's.x', 'g.lam')})) + (g.lam - 1) * {_jac(method, 's.x')} AS llf
             FROM {src} s, {name}_g g WHERE s.x IS NOT NULL GROUP BY g.lam),
{name} AS (SELECT lam FROM {name}_l ORDER BY llf DESC LIMIT 1)"""


@query("scl_standard_minmax", ("SCL-1", "SCL-2"), with_views("""
, p AS (SELECT avg(bal) AS mb, stddev_pop(bal) AS sb, min(bal) AS lb, max(bal) AS hb,
               avg(target) AS mt, stddev_pop(target) AS st, min(target) AS lt, max(target) AS ht FROM trades)
SELECT row_id, round((bal - mb) / sb, 8) AS bal_std, round((bal - lb) / (hb - lb), 8) AS bal_mm,
       round((target - mt) / st, 8) AS target_std, round((target - lt) / (ht - lt), 8) AS target_mm
FROM trades, p
""", "trades"))
def q_std_mm(spark, sf):
    t = views.trades(spark, sf).select("row_id", "bal", "target")
    sp = scale.standard_params(t, ["bal", "target"])
    mp = scale.minmax_params(t, ["bal", "target"])
    t = scale.affine(scale.affine(t, sp, "_std"), mp, "_mm")
    return t.select("row_id", *[F.round(c, 8).alias(c) for c in ["bal_std", "bal_mm", "target_std", "target_mm"]])


@query("scl_robust_train", "SCL-3", with_views("""
, p AS (SELECT quantile_cont(area, 0.5) AS ma, quantile_cont(area, 0.75) - quantile_cont(area, 0.25) AS ia,
               quantile_cont(target, 0.5) AS mt, quantile_cont(target, 0.75) - quantile_cont(target, 0.25) AS it
        FROM trades WHERE is_test = 0)
SELECT row_id, round((area - ma) / ia, 8) AS area, round((target - mt) / it, 8) AS target FROM trades, p
""", "trades"))
def q_robust(spark, sf):
    t = views.trades(spark, sf).select("row_id", "area", "target", "is_test")
    rp = scale.robust_params(t.where("is_test = 0"), ["area", "target"])
    out = scale.affine(t, rp)
    return out.select("row_id", F.round("area", 8).alias("area"), F.round("target", 8).alias("target"))


@query("scl_skew_g1", "SCL-4", """
SELECT 'n_chars' AS column, round(skewness(n_chars), 6) AS g1, abs(skewness(n_chars)) > 0.5 AS skewed FROM documents
UNION ALL
SELECT 'value', round(skewness(value), 6), abs(skewness(value)) > 0.5 FROM events
""")
def q_skew(spark, sf):
    d = scale.skewness_g1(table(spark, sf, "documents"), ["n_chars"])["n_chars"]
    e = scale.skewness_g1(table(spark, sf, "events"), ["value"])["value"]
    rows = [("n_chars", round(d, 6), abs(d) > 0.5), ("value", round(e, 6), abs(e) > 0.5)]
    return spark.createDataFrame(rows, "column string, g1 double, skewed boolean")


@query("scl_log_shift", "SCL-5", f"""
WITH m AS (SELECT min(n_chars) AS m FROM documents WHERE NOT ({HOLD}))
SELECT doc_id, round(CASE WHEN n_chars - m + 2 > 0 THEN ln(n_chars - m + 2) END, 8) AS n_chars FROM documents, m
""")
def q_log_shift(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    mins = scale.log_shift_params(d.where(~is_holdout("doc_id")), ["n_chars"])
    return scale.log_shift(d, mins).select("doc_id", F.round("n_chars", 8).alias("n_chars"))


@query("scl_yeo_johnson", "SCL-6", f"""
WITH x AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x FROM documents),
{best_lambda_sql('x', 'yeo-johnson', 'b')},
t AS (SELECT x.doc_id, {_psi('yeo-johnson', 'x.x', 'b.lam')} AS p, b.lam FROM x, b),
s AS (SELECT avg(p) AS m, stddev_pop(p) AS sd FROM t)
SELECT t.doc_id, t.lam AS lambda, round((t.p - s.m) / s.sd, 6) AS value FROM t, s
""")
def q_yj(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lam, _ = scale.power_lambda(d, "n_chars", "yeo-johnson")
    out = scale.power_transform(d, "n_chars", lam, "yeo-johnson", out="value")
    return out.select("doc_id", F.lit(lam).alias("lambda"), F.round("value", 6).alias("value"))


def _choice_sql():
    parts, ctes = [], []
    for name, src in (("n_chars", "SELECT CAST(n_chars AS DOUBLE) AS x FROM documents"),
                      ("value", "SELECT value AS x FROM events"),
                      ("bal", "SELECT bal AS x FROM trades")):
        ctes.append(f"s_{name} AS ({src})")
        ctes.append(best_lambda_sql(f"s_{name}", "box-cox", f"bc_{name}").strip())
        ctes.append(best_lambda_sql(f"s_{name}", "yeo-johnson", f"yj_{name}").strip())
        parts.append(f"SELECT '{name}' AS column, CASE WHEN (SELECT min(x) FROM s_{name}) > 0 THEN 'box-cox' ELSE 'yeo-johnson' END AS method, "
                     f"CASE WHEN (SELECT min(x) FROM s_{name}) > 0 THEN (SELECT lam FROM bc_{name}) ELSE (SELECT lam FROM yj_{name}) END AS lambda")
    return with_views(", " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts), "trades")


@query("scl_power_choice", "SCL-7", _choice_sql())
def q_power_choice(spark, sf):
    rows = []
    for name, df in (("n_chars", table(spark, sf, "documents")), ("value", table(spark, sf, "events")),
                     ("bal", views.trades(spark, sf))):
        method, lam = scale.choose_power(df, name)
        rows.append((name, method, lam))
    return spark.createDataFrame(rows, "column string, method string, lambda double")


def _auto_sql():
    parts, ctes = [], [", tr AS (SELECT bal, target, exp(area / 20e0) AS growth, contract_day FROM trades WHERE is_test = 0)"]
    for c in ["bal", "target", "growth"]:
        ctes.append(f"r_{c} AS (SELECT quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr, "
                    f"skewness({c}) AS g FROM tr)")
        ctes.append(f"x_{c} AS (SELECT ({c} - med) / iqr AS x FROM tr, r_{c})")
        ctes.append(best_lambda_sql(f"x_{c}", "yeo-johnson", f"l_{c}").strip())
        ctes.append(f"t_{c} AS (SELECT avg({_psi('yeo-johnson', 'x', 'lam')}) AS m, stddev_pop({_psi('yeo-johnson', 'x', 'lam')}) AS s "
                    f"FROM x_{c}, l_{c} WHERE x IS NOT NULL)")
        parts.append(f"SELECT '{c}' AS column, CASE WHEN abs(g) > 1 THEN 'robust+yeo-johnson' ELSE 'robust' END AS kind, "
                     f"round(med, 6) AS center, round(iqr, 6) AS scale, CASE WHEN abs(g) > 1 THEN lam END AS lambda, "
                     f"CASE WHEN abs(g) > 1 THEN round(m, 6) END AS mean, CASE WHEN abs(g) > 1 THEN round(s, 6) END AS std "
                     f"FROM r_{c}, l_{c}, t_{c}")
    parts.insert(0, "SELECT 'contract_day' AS column, 'standard' AS kind, round(avg(contract_day), 6) AS center, "
                    "round(stddev_pop(contract_day), 6) AS scale, CAST(NULL AS DOUBLE) AS lambda, CAST(NULL AS DOUBLE) AS mean, "
                    "CAST(NULL AS DOUBLE) AS std FROM tr")
    return with_views(",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts), "trades")


@query("scl_auto_scaler", ("SCL-8",), _auto_sql())
def q_auto(spark, sf):
    t = views.trades(spark, sf).where("is_test = 0").select(
        "bal", "target", F.exp(F.col("area") / F.lit(20.0)).alias("growth"), "contract_day")
    rows = scale.auto_scaler_params(t, ["bal", "target", "growth"], ["contract_day"])

    def r(v):
        return None if v is None else round(float(v), 6)
    out = [(c, k, r(a), r(b), lam, r(m), r(s)) for c, k, a, b, lam, m, s in rows]
    return spark.createDataFrame(out, "column string, kind string, center double, scale double, lambda double, "
                                      "mean double, std double")


@query("scl_skew_bundle", "SCL-9", f"""
WITH tr AS (SELECT * FROM documents WHERE NOT ({HOLD})),
m AS (SELECT min(n_chars) AS m, skewness(n_chars) AS g FROM tr),
lt AS (SELECT doc_id, CASE WHEN g > 0.5 THEN ln(n_chars - m + 2) ELSE n_chars END AS v, ({HOLD}) AS hold FROM documents, m),
p AS (SELECT quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM lt WHERE NOT hold)
SELECT doc_id, round((v - med) / iqr, 6) AS n_chars FROM lt, p
""")
def q_bundle(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    hold = is_holdout("doc_id")
    tr, te, _ = scale.skew_bundle(d.where(~hold), d.where(hold), ["n_chars"])
    return tr.unionByName(te).select("doc_id", F.round("n_chars", 6).alias("n_chars"))


@query("out_iqr_modified", "OUT-1", with_views("""
, q AS (SELECT quantile_cont(target, 0.25) AS q1, quantile_cont(target, 0.75) AS q3 FROM trades WHERE is_test = 0)
SELECT row_id FROM trades, q WHERE is_test = 1 OR target BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 290e0
""", "trades"))
def q_iqr_mod(spark, sf):
    t = views.trades(spark, sf).select("row_id", "target", "is_test")
    return outliers.iqr_filter_train(t, "target", mode="modified").select("row_id")


@query("out_zscore", "OUT-2", with_views("""
, p AS (SELECT avg(bal) AS mb, stddev_pop(bal) AS sb, avg(target) AS mt, stddev_pop(target) AS st FROM trades)
SELECT row_id FROM trades, p WHERE abs(bal - mb) / sb < 1.5 AND abs(target - mt) / st < 1.5
""", "trades"))
def q_zscore(spark, sf):
    t = views.trades(spark, sf).select("row_id", "bal", "target")
    return outliers.zscore_filter(t, ["bal", "target"], 1.5).select("row_id")


@query("out_iqr_mask", "OUT-3", with_views("""
, q AS (SELECT quantile_cont(area, 0.25) AS a1, quantile_cont(area, 0.75) AS a3,
               quantile_cont(target, 0.25) AS t1, quantile_cont(target, 0.75) AS t3 FROM trades)
SELECT row_id,
       CASE WHEN area BETWEEN a1 - 0.5 * (a3 - a1) AND a3 + 0.5 * (a3 - a1) THEN area END AS area,
       CASE WHEN target BETWEEN t1 - 0.5 * (t3 - t1) AND t3 + 0.5 * (t3 - t1) THEN target END AS target
FROM trades, q
""", "trades"))
def q_mask(spark, sf):
    t = views.trades(spark, sf).select("row_id", "area", "target")
    return outliers.iqr_mask_cells(t, ["area", "target"], k=0.5)
