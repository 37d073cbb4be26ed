"""Encoder queries (2.11) and dense codes (WIN-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode
from ..operators.ordering import with_position
from ..sources import views
from ..sources.store import cut_lineage
from ..sources.tables import table
from .registry import query
from .sqltext import with_views


def _codes_sql(col, alias):
    return f"""
{alias}_tr AS (SELECT DISTINCT coalesce(CAST({col} AS VARCHAR), 'NULL') AS v FROM trades WHERE is_test = 0),
{alias}_te AS (SELECT DISTINCT coalesce(CAST({col} AS VARCHAR), 'NULL') AS v FROM trades WHERE is_test = 1
               AND coalesce(CAST({col} AS VARCHAR), 'NULL') NOT IN (SELECT v FROM {alias}_tr)),
{alias} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM {alias}_tr
            UNION ALL
            SELECT v, (SELECT count(*) FROM {alias}_tr) + row_number() OVER (ORDER BY v) - 1 FROM {alias}_te)"""


@query("enc_label_unseen", ("ENC-1", "ENC-3", "JOI-3"), with_views(f"""
, {_codes_sql('heating', 'ch')}, {_codes_sql('complex', 'cc')}
SELECT t.row_id, t.is_test, ch.code AS heating_code, ch.v AS heating_decoded, cc.code AS complex_code
FROM trades t JOIN ch ON coalesce(t.heating, 'NULL') = ch.v JOIN cc ON coalesce(t.complex, 'NULL') = cc.v
""", "trades"))
def q_label(spark, sf):
    t = cut_lineage(views.trades(spark, sf).select("row_id", "is_test", "heating", "complex"), "labels")
    train, test = t.where("is_test = 0"), t.where("is_test = 1")
    ch = encode.label_codes(train, test, "heating")
    cc = encode.label_codes(train, test, "complex")
    enc = encode.apply_codes(t, "heating", ch, out="heating_code")
    enc = encode.apply_codes(enc, "complex", cc, out="complex_code")
    dec = encode.decode(enc.select("row_id", "is_test", "heating_code", "complex_code",
                                   F.col("heating_code").alias("heating_decoded")), "heating_decoded", ch)
    return dec.select("row_id", "is_test", "heating_code", "heating_decoded", "complex_code")


@query("enc_label_union", ("ENC-2", "NUL-6"), with_views("""
, c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(heating, 'Unknown') AS v FROM trades))
SELECT t.row_id, c.code AS heating FROM trades t JOIN c ON coalesce(t.heating, 'Unknown') = c.v
""", "trades"))
def q_label_union(spark, sf):
    t = views.trades(spark, sf).select("row_id", "heating")
    enc, _ = encode.label_encode_union(t, ["heating"])
    return enc


@query("enc_min_frequency", "ENC-4", with_views(" UNION ALL ".join(
    [f"SELECT '{c}' AS column, 'percentile' AS strategy, greatest(1, CAST(floor(quantile_cont(n, 0.05)) AS BIGINT)) AS min_freq "
     f"FROM (SELECT count(*) AS n FROM trades WHERE {c} IS NOT NULL GROUP BY {c})" for c in ["district", "hood", "complex", "heating"]]
    + [f"SELECT '{c}', 'fixed', greatest(1, CAST(floor(count(*) * 0.05) AS BIGINT)) FROM trades"
       for c in ["district", "hood", "complex", "heating"]]), "trades"))
def q_min_freq(spark, sf):
    t = views.trades(spark, sf)
    return encode.min_frequencies(t, ["district", "hood", "complex", "heating"], 0.05)


RARE_MIN = 12


@query("enc_rare_codes", "ENC-5", with_views(f"""
, cnt AS (SELECT complex AS v, count(*) AS n FROM trades WHERE is_test = 0 AND complex IS NOT NULL GROUP BY 1),
lab AS (SELECT row_id, is_test,
               CASE WHEN complex IN (SELECT v FROM cnt WHERE n >= {RARE_MIN}) THEN complex ELSE 'OTHER' END AS lab FROM trades),
codes AS (SELECT lab, row_number() OVER (ORDER BY lab) - 1 AS code FROM (SELECT DISTINCT lab FROM lab WHERE is_test = 0))
SELECT row_id, is_test, code AS complex_code FROM lab LEFT JOIN codes USING (lab)
""", "trades"))
def q_rare(spark, sf):
    t = views.trades(spark, sf).select("row_id", "is_test", "complex")
    frequent, codes = encode.rare_codes(t.where("is_test = 0"), "complex", RARE_MIN)
    return encode.apply_rare(t, "complex", frequent, codes, out="complex_code").select("row_id", "is_test", "complex_code")


@query("enc_target_mean", "ENC-6", with_views("""
, d AS (SELECT district AS v, avg(target) AS te FROM trades WHERE is_test = 0 GROUP BY 1),
h AS (SELECT heating AS v, avg(target) AS te FROM trades WHERE is_test = 0 AND heating IS NOT NULL GROUP BY 1),
g AS (SELECT avg(target) AS g FROM trades WHERE is_test = 0)
SELECT t.row_id, t.is_test,
       round(CASE WHEN t.is_test = 1 THEN coalesce(d.te, g.g) ELSE d.te END, 4) AS district_te,
       round(CASE WHEN t.is_test = 1 THEN coalesce(h.te, g.g) ELSE h.te END, 4) AS heating_te
FROM trades t LEFT JOIN d ON t.district = d.v LEFT JOIN h ON t.heating = h.v, g
""", "trades"))
def q_target_mean(spark, sf):
    t = views.trades(spark, sf).select("row_id", "is_test", "district", "heating", "target")
    train, test = t.where("is_test = 0"), t.where("is_test = 1")
    tr, te = encode.target_encode(train, test, ["district", "heating"], "target")
    out = tr.unionByName(te)
    return out.select("row_id", "is_test", F.round("district", 4).alias("district_te"),
                      F.round("heating", 4).alias("heating_te"))


@query("enc_one_hot", "ENC-7", with_views("""
SELECT row_id,
       CAST(coalesce(heating = '1-URGENT', false) AS INTEGER) AS "heating_1-URGENT",
       CAST(coalesce(heating = '2-HIGH', false) AS INTEGER) AS "heating_2-HIGH",
       CAST(coalesce(heating = '3-MEDIUM', false) AS INTEGER) AS "heating_3-MEDIUM",
       CAST(coalesce(heating = '4-NOT SPECIFIED', false) AS INTEGER) AS "heating_4-NOT SPECIFIED",
       CAST(coalesce(heating = '5-LOW', false) AS INTEGER) AS "heating_5-LOW"
FROM trades
""", "trades"))
def q_one_hot(spark, sf):
    t = views.trades(spark, sf).select("row_id", "heating", "is_test")
    oh = encode.one_hot(t.where("is_test = 0"), t, "heating")
    return oh.drop("heating", "is_test")


@query("enc_one_hot_long", "ENC-7", with_views("""
SELECT row_id, complex AS level FROM trades WHERE complex IN (SELECT complex FROM trades WHERE is_test = 0)
""", "trades"))
def q_one_hot_long(spark, sf):
    """A category for each complex: too many for columns."""
    t = views.trades(spark, sf).select("row_id", "complex", "is_test")
    return encode.one_hot_long(t.where("is_test = 0"), t, "complex")


@query("win_dense_codes", "WIN-4", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS type_code FROM part
""")
def q_dense(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    codes = with_position(p.select("p_type").distinct(), "p_type", "type_code")
    return p.join(codes, "p_type").select("p_partkey", "type_code")


@query("win_dense_codes_null_bigid", "WIN-4", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS BIGINT) AS pos
FROM (SELECT o_orderkey, CASE WHEN o_orderkey <> 7 THEN o_orderkey + 1152921504606846976 END AS k FROM orders)
""")
def q_dense_big(spark, sf):
    k = F.when(F.col("o_orderkey") != 7, F.col("o_orderkey") + F.lit(1152921504606846976))  # beyond 2^53; one null
    o = table(spark, sf, "orders").select("o_orderkey", k.alias("k"))
    return with_position(o, "k", "pos").select("o_orderkey", "pos")


_FOLD5 = "CAST(((((row_id % 2147483648) * 2654435761) % 4294967296) % 4294967296) % 5 AS INTEGER)"


@query("enc_target_mean_oof", "ENC-6", with_views(f"""
, d AS (SELECT row_id, district, target, {_FOLD5} AS fold FROM trades),
o AS (SELECT t1.row_id, avg(t2.target) AS m FROM d t1 JOIN d t2 ON t1.district = t2.district AND t2.fold <> t1.fold GROUP BY t1.row_id),
g AS (SELECT f.fold, avg(d.target) AS g FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY f.fold)
SELECT d.row_id, round(coalesce(o.m, g.g), 2) AS district_te FROM d LEFT JOIN o ON d.row_id = o.row_id JOIN g ON d.fold = g.fold
""", "trades"))
def q_te_oof(spark, sf):
    from ..operators.model import add_folds
    t = add_folds(views.trades(spark, sf).select("row_id", "district", "target"), 5)
    e = encode.target_means_oof(t, "district", "target", "fold", out="district_te")
    return e.select("row_id", F.round("district_te", 2).alias("district_te"))
