"""Flagship query and the scalar / schema / filter / set / join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import token
from ..operators import encode, nulls, outliers
from ..operators.features import prep_feat
from ..operators.model import rmse_by
from ..sources import views
from ..sources.store import cut_lineage
from .registry import query
from .sqltext import with_views

# Fixed values used by the trade queries: seven district names of the test
# data standing in for the reference's seven core districts.
CORE = ("NATION_1", "NATION_3", "NATION_6", "NATION_8", "NATION_12", "NATION_19", "NATION_22")
CORE_SQL = ", ".join(f"'{v}'" for v in CORE)
GROUPS = ["district", "hood", "complex"]


# ---------------------------------------------------------------------------
# Flagship: RMSE per region of a target-mean predictor on cleaned trades.
# trades -> FUN-12 -> NUL-1 -> NUL-4 -> OUT-1 -> ENC-6 -> EVA-1
# ---------------------------------------------------------------------------

def cleaned_trades(spark, sf):
    t = views.trades(spark, sf).withColumn("region", token("addr", 0))
    t = prep_feat(t, core=CORE)
    t = nulls.sentinels_to_null(t, ["deal_type"])
    t = cut_lineage(nulls.hierarchical_fill(t, ["area"], [], GROUPS))
    return outliers.iqr_filter_train(t, "area")


def flagship(spark, sf):
    t = cleaned_trades(spark, sf)
    train, test = t.where("is_test = 0"), t.where("is_test = 1")
    means, g = encode.target_means(train, "district", "target")
    scored = encode.apply_target_means(test, "district", means, g, out="pred")
    return rmse_by(scored, "target", "pred", ["region"])


_HFILL_SQL = """
, t0 AS (SELECT *, split_part(addr, ' ', 1) AS region FROM trades),
l3 AS (SELECT * REPLACE (coalesce(area, avg(area) OVER (PARTITION BY district, hood, complex)) AS area) FROM t0),
l2 AS (SELECT * REPLACE (coalesce(area, avg(area) OVER (PARTITION BY district, hood)) AS area) FROM l3),
l1 AS (SELECT * REPLACE (coalesce(area, avg(area) OVER (PARTITION BY district)) AS area) FROM l2),
l0 AS (SELECT * REPLACE (coalesce(area, avg(area) OVER ()) AS area) FROM l1),
q AS (SELECT quantile_cont(area, 0.25) AS q1, quantile_cont(area, 0.75) AS q3 FROM l0 WHERE is_test = 0),
kept AS (SELECT l0.* FROM l0, q WHERE is_test = 1 OR area BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
"""

FLAGSHIP_SQL = with_views(_HFILL_SQL + """,
te AS (SELECT district, avg(target) AS te FROM kept WHERE is_test = 0 GROUP BY district),
g AS (SELECT avg(target) AS g FROM kept WHERE is_test = 0),
scored AS (SELECT k.region, k.target, coalesce(te.te, g.g) AS pred
           FROM kept k LEFT JOIN te ON k.district = te.district, g WHERE k.is_test = 1)
SELECT region, CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((target - pred) * (target - pred))), 4) AS rmse
FROM scored GROUP BY region
""", "trades")

query("flagship_region_rmse", ("FUN-12", "NUL-4", "OUT-1", "ENC-6", "EVA-1"), FLAGSHIP_SQL, headline=True)(flagship)


# ---------------------------------------------------------------------------
# Scalar functions and derived features (2.10)
# ---------------------------------------------------------------------------

from ..functions import scalar as fx  # noqa: E402
from ..operators import combine, schema  # noqa: E402
from ..operators.features import polynomial  # noqa: E402
from ..sources.tables import table  # noqa: E402


@query("fun_address_date_flags", ("FUN-1", "FUN-2", "FUN-3", "FUN-4", "FUN-5", "FUN-12"), with_views(f"""
SELECT row_id,
       string_split_regex(trim(addr), '\\s+')[2] AS gu,
       string_split_regex(trim(addr), '\\s+')[3] AS dong,
       substr(CAST(contract_ym AS VARCHAR), 1, 4) AS contract_year,
       substr(CAST(contract_ym AS VARCHAR), 5) AS contract_month,
       CAST(coalesce(string_split_regex(trim(addr), '\\s+')[2] IN ({CORE_SQL}), false) AS INTEGER) AS is_core,
       CAST(coalesce(built_year >= 2009, false) AS INTEGER) AS is_new,
       addr || CAST(contract_day AS VARCHAR) AS addr_lot
FROM trades
""", "trades"))
def q_fun_features(spark, sf):
    t = views.trades(spark, sf).select("row_id", "addr", "contract_ym", "built_year", "contract_day")
    f = prep_feat(t, core=CORE, lot_col="contract_day")
    return f.select("row_id", "gu", "dong", "contract_year", "contract_month", "is_core", "is_new", "addr_lot")


@query("fun_epoch_seconds", "FUN-6", """
SELECT o_orderkey, CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate) AS DOUBLE) AS epoch_s
FROM orders
""")
def q_epoch(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", fx.epoch_seconds("o_orderdate").alias("epoch_s"))


@query("fun_log_target", "FUN-7", with_views("""
SELECT row_id, round(ln(target), 8) AS log_target, round(exp(ln(target)), 4) AS back
FROM trades
""", "trades"))
def q_log_target(spark, sf):
    t = views.trades(spark, sf)
    return t.select("row_id", F.round(F.ln("target"), 8).alias("log_target"),
                    F.round(F.exp(F.ln("target")), 4).alias("back"))


@query("fun_error_terms", "FUN-8", with_views("""
SELECT row_id, round((target - bal) * (target - bal), 2) AS sq_err, round(abs(target - bal), 4) AS abs_diff
FROM trades
""", "trades"))
def q_error_terms(spark, sf):
    t = views.trades(spark, sf)
    d = F.col("target") - F.col("bal")
    return t.select("row_id", F.round(d * d, 2).alias("sq_err"), F.round(F.abs(d), 4).alias("abs_diff"))


@query("fun_polynomial_clean_names", ("FUN-9", "PRJ-6"), with_views("""
SELECT row_id, round(bal * bal, 4) AS bal_2, round(bal * target, 4) AS bal_target,
       CAST(contract_day * contract_day AS DOUBLE) AS contract_day_2,
       round(bal * contract_day, 4) AS bal_contract_day, round(target * target, 2) AS target_2,
       round(target * contract_day, 4) AS target_contract_day
FROM trades
""", "trades"))
def q_poly(spark, sf):
    t = views.trades(spark, sf).select("row_id", "bal", "target", "contract_day")
    p = polynomial(t, ["bal", "target", "contract_day"]).drop("bal", "target", "contract_day")
    p = schema.clean_names_word(p)
    rounding = {"bal_2": 4, "bal_target": 4, "bal_contract_day": 4, "target_2": 2, "target_contract_day": 4}
    return p.select("row_id", *[F.round(F.col(c), rounding[c]).alias(c) if c in rounding
                                else F.col(c).cast("double").alias(c) for c in p.columns if c != "row_id"])


@query("fun_comma_list", "FUN-11", with_views("""
SELECT row_id, len(l) AS n_items, array_to_string(l, '|') AS items
FROM (SELECT row_id, list_transform(string_split(district || ' ,' || hood || ', ' || complex, ','), lambda x: trim(x)) AS l
      FROM trades)
""", "trades"))
def q_comma_list(spark, sf):
    t = views.trades(spark, sf)
    arr = fx.comma_list(F.concat_ws(" ,", "district", F.concat_ws(", ", "hood", "complex")))
    return t.select("row_id", F.size(arr).cast("bigint").alias("n_items"), F.array_join(arr, "|").alias("items"))


# ---------------------------------------------------------------------------
# Projection, filter, schema (2.2)
# ---------------------------------------------------------------------------

_PRESETS = {
    "minimum": "row_id, target, is_test, district, area, contract_ym, built_year, hood, complex, heating, lat, lon",
    "manual": "row_id, target, is_test, area, contract_ym, contract_day, district, hood, built_year",
    "features_all": "row_id, target, is_test, district, area, contract_ym, built_year, hood, complex, bal, contract_day",
    "wrapper": "row_id, target, is_test, district, area, contract_ym, built_year, hood, complex, bal, contract_day",
    "baseline": "row_id, district, hood, complex, contract_ym, contract_day, built_year, area, heating, bal, lon, lat, target, is_test",
    "remove_all": "row_id, hood, contract_ym, contract_day, built_year, area, bal, lon, lat, target, is_test",
}
for _name, _cols in _PRESETS.items():
    query(f"prj_preset_{_name}", "PRJ-1", with_views(f"SELECT {_cols} FROM trades", "trades"))(
        lambda spark, sf, _name=_name: schema.select_preset(views.trades(spark, sf), _name))


@query("prj_xy_split", "PRJ-9", with_views("""
SELECT row_id, district, area, target AS y FROM trades
""", "trades"))
def q_xy_split(spark, sf):
    t = views.trades(spark, sf).select("row_id", "is_test", "district", "area", "target")
    x, y = schema.xy_split(t, "target")
    return x.join(y.withColumnRenamed("target", "y"), "row_id").select("row_id", "district", "area", "y")


@query("prj_drop_present_dedupe", ("PRJ-2", "PRJ-3", "PRJ-4", "PRJ-5"), with_views("""
SELECT row_id, district, hood, area, target FROM trades
""", "trades"))
def q_drop_present(spark, sf):
    t = views.trades(spark, sf).select("row_id", F.col("row_id").alias("Unnamed: 0"), "district", "hood",
                                       "area", "target", F.col("target").alias("target"), "mostly_null")
    t = schema.dedupe_names(t)
    t = schema.drop_unnamed(t)
    t = schema.drop_present(t, ["mostly_null", "no_such_column"])
    t, _ = schema.clean_names_map(t)
    return t


@query("prj_to_numeric", ("PRJ-7", "PRJ-8"), with_views("""
SELECT row_id, CAST(substr(CAST(contract_ym AS VARCHAR), 1, 4) AS DOUBLE) AS contract_year,
       CAST(substr(CAST(contract_ym AS VARCHAR), 5) AS DOUBLE) AS contract_month,
       deal_type, CAST(built_year AS VARCHAR) AS built_year, CAST(contract_day AS DOUBLE) AS contract_day
FROM trades
""", "trades"))
def q_to_numeric(spark, sf):
    t = views.trades(spark, sf).select("row_id", "contract_ym", "deal_type", "built_year", "contract_day")
    t = prep_feat(t, core=CORE).drop("is_core", "is_new")
    t = schema.cast_columns(t, to_string=["built_year"], to_double=["contract_day"])
    t = schema.to_numeric_if_possible(t, ["contract_year", "contract_month", "deal_type"])
    return t


@query("fil_split_test", "FIL-1", with_views("""
SELECT row_id, district, area, 0e0 AS target FROM trades WHERE is_test = 1
""", "trades"))
def q_split(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "area", "target", "is_test")
    _, test = combine.split_train_test(t)
    return test


@query("fil_null_coords", ("FIL-2", "FUN-5"), with_views("""
SELECT row_id, district || ' ' || hood AS address FROM trades WHERE lon IS NULL OR lat IS NULL
""", "trades"))
def q_null_coords(spark, sf):
    from ..operators.features import address
    t = address(views.trades(spark, sf), ["district", "hood"])
    return t.where(F.col("lon").isNull() | F.col("lat").isNull()).select("row_id", "address")


@query("fil_dropna_dedup", ("FIL-3", "FIL-4"), """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL
""")
def q_dedup(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.dropna(subset=["l_returnflag"]).dropDuplicates()


@query("fil_isin_box", ("FIL-5", "FIL-6"), with_views(f"""
SELECT row_id, district FROM trades
WHERE district IN ({CORE_SQL}) AND lon BETWEEN 126.5e0 AND 127.5e0 AND lat BETWEEN 37.0e0 AND 38.0e0
""", "trades"))
def q_isin_box(spark, sf):
    t = views.trades(spark, sf)
    return t.where(F.col("district").isin(list(CORE)) & F.col("lon").between(126.5, 127.5)
                   & F.col("lat").between(37.0, 38.0)).select("row_id", "district")


# ---------------------------------------------------------------------------
# Joins (2.3)
# ---------------------------------------------------------------------------

@query("joi_landmark_distance", ("JOI-1", "GEO-1", "GEO-2"), with_views("""
SELECT t.row_id, t.district, round(2 * 6371.0e0 * atan2(sqrt(a), sqrt(1 - a)), 6) AS landmark_km
FROM (SELECT t.row_id, t.district,
             pow(sin((radians(m.lead_lat) - radians(t.lat)) / 2), 2)
             + cos(radians(t.lat)) * cos(radians(m.lead_lat)) * pow(sin((radians(m.lead_lon) - radians(t.lon)) / 2), 2) AS a
      FROM trades t JOIN landmarks m ON t.district = m.district) t
""", "trades", "landmarks"))
def q_landmark(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "lat", "lon")
    j = combine.landmark_distance(t, views.landmarks(spark, sf))
    return j.select("row_id", "district", F.round("landmark_km", 6).alias("landmark_km"))


@query("joi_value_map", "JOI-2", with_views("""
SELECT t.row_id, coalesce(m.code, -1) AS region_code
FROM trades t LEFT JOIN (SELECT n_name, CAST(n_regionkey AS BIGINT) AS code FROM nation WHERE n_regionkey <> 2) m
ON t.district = m.n_name
""", "trades"))
def q_value_map(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district")
    m = table(spark, sf, "nation").where("n_regionkey <> 2") \
        .select(F.col("n_name").alias("district"), F.col("n_regionkey").cast("bigint").alias("code"))
    return t.join(F.broadcast(m), "district", "left") \
            .select("row_id", F.coalesce(F.col("code"), F.lit(-1).cast("bigint")).alias("region_code"))


@query("joi_unseen_labels", "JOI-3", with_views("""
SELECT DISTINCT heating FROM trades WHERE is_test = 1 AND heating IS NOT NULL
EXCEPT SELECT DISTINCT heating FROM trades WHERE is_test = 0 AND heating IS NOT NULL
""", "trades"))
def q_unseen(spark, sf):
    t = views.trades(spark, sf).select("heating", "is_test").where(F.col("heating").isNotNull())
    tr = t.where("is_test = 0").select("heating").distinct()
    return t.where("is_test = 1").select("heating").distinct().join(tr, "heating", "left_anti")


@query("joi_concat_side", ("JOI-4", "SRC-3"), with_views("""
SELECT t.row_id, t.district, t.bal, s.f_year FROM trades t JOIN side_features s ON t.row_id = s.row_id
""", "trades", "side_features"))
def q_concat(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "bal")
    return combine.concat_by_key(t, views.side_features(spark, sf))


@query("joi_address_enrich", "JOI-6", with_views("""
SELECT t.row_id,
       CASE WHEN t.lon IS NULL OR t.lat IS NULL THEN coalesce(t.lon, b.lon) ELSE t.lon END AS lon,
       CASE WHEN t.lon IS NULL OR t.lat IS NULL THEN coalesce(t.lat, b.lat) ELSE t.lat END AS lat
FROM trades t LEFT JOIN (SELECT complex, min(lon) AS lon, min(lat) AS lat FROM address_book
                         WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY complex) b
  ON t.complex = b.complex AND (t.lon IS NULL OR t.lat IS NULL)
""", "trades", "address_book"))
def q_enrich(spark, sf):
    t = views.trades(spark, sf).select("row_id", "complex", "lon", "lat")
    filled, _ = combine.lookup_fill(t, views.address_book(spark, sf), "complex", ["lon", "lat"])
    return filled.select("row_id", "lon", "lat")


@query("joi_address_misses", "JOI-6", with_views("""
SELECT CAST(count(*) AS BIGINT) AS keys, CAST(count(*) FILTER (WHERE b.complex IS NULL) AS BIGINT) AS misses
FROM (SELECT DISTINCT complex FROM trades WHERE lon IS NULL OR lat IS NULL) k
LEFT JOIN (SELECT DISTINCT complex FROM address_book WHERE lon IS NOT NULL AND lat IS NOT NULL) b
  ON k.complex = b.complex
""", "trades", "address_book"))
def q_enrich_report(spark, sf):
    t = views.trades(spark, sf).select("row_id", "complex", "lon", "lat")
    _, report = combine.lookup_fill(t, views.address_book(spark, sf), "complex", ["lon", "lat"])
    return report


# ---------------------------------------------------------------------------
# Sets, sort, sampling, sources and sinks (2.1, 2.8, 2.9)
# ---------------------------------------------------------------------------

@query("set_stack_train_test", ("SET-1", "SRC-2"), with_views("""
SELECT row_id, district, area AS area_m2, CASE WHEN is_test = 1 THEN 0e0 ELSE target END AS target, is_test
FROM trades
""", "trades"))
def q_stack(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "area", "target", "is_test")
    train = t.where("is_test = 0").drop("is_test")
    test = t.where("is_test = 1").drop("is_test", "target")
    return combine.stack_train_test(train, test, renames={"area": "area_m2"})


@query("set_restack", "SET-2", with_views("""
SELECT row_id, CAST(lon IS NOT NULL AND lat IS NOT NULL AS INTEGER) AS has_coord FROM trades
""", "trades"))
def q_restack(spark, sf):
    t = views.trades(spark, sf).select("row_id", "lon", "lat")
    miss = F.col("lon").isNull() | F.col("lat").isNull()
    a = t.where(miss).withColumn("has_coord", F.lit(0))
    b = t.where(~miss).withColumn("has_coord", F.lit(1))
    return a.unionByName(b).select("row_id", "has_coord")


@query("srt_worst_best_100", ("SRT-1", "EVA-6"), with_views("""
, m AS (SELECT district, avg(target) AS te FROM trades WHERE is_test = 0 GROUP BY district),
e AS (SELECT t.row_id, round((t.target - m.te) * (t.target - m.te), 2) AS sq_err
      FROM trades t JOIN m ON t.district = m.district WHERE t.is_test = 1),
w AS (SELECT 'worst' AS kind, row_id, sq_err FROM e ORDER BY sq_err DESC, row_id LIMIT 100),
b AS (SELECT 'best' AS kind, row_id, sq_err FROM e ORDER BY sq_err ASC, row_id LIMIT 100)
SELECT * FROM w UNION ALL SELECT * FROM b
""", "trades"))
def q_worst_best(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "target", "is_test")
    means, _ = encode.target_means(t.where("is_test = 0"), "district", "target")
    e = encode.apply_target_means(t.where("is_test = 1"), "district", means, None, out="pred") \
              .select("row_id", F.round((F.col("target") - F.col("pred")) ** 2, 2).alias("sq_err"))
    e = e.where(F.col("sq_err").isNotNull())
    worst = e.orderBy(F.col("sq_err").desc(), "row_id").limit(100).select(F.lit("worst").alias("kind"), "row_id", "sq_err")
    best = e.orderBy(F.col("sq_err").asc(), "row_id").limit(100).select(F.lit("best").alias("kind"), "row_id", "sq_err")
    return worst.unionByName(best)


@query("smp_hash_fraction", "SMP-2", with_views("""
SELECT row_id, district FROM trades WHERE (((row_id % 2147483648) * 2654435761) % 4294967296) % 1000 < 100
""", "trades"))
def q_hash_sample(spark, sf):
    return combine.hash_sample(views.trades(spark, sf).select("row_id", "district"), "row_id", 0.1)


@query("smp_bootstrap", "SMP-1")
def q_bootstrap(spark, sf):
    return combine.bootstrap(views.trades(spark, sf).select("row_id", "target"), 0.02, seed=42)


@query("snk_prediction_cast", "SNK-2", with_views("""
SELECT row_id, CAST(trunc(target / 3e0) AS BIGINT) AS pred FROM trades WHERE is_test = 1
""", "trades"))
def q_pred_cast(spark, sf):
    from ..session import scratch_path
    from ..sources import files
    t = views.trades(spark, sf).where("is_test = 1")
    pred = t.select("row_id", (F.col("target") / F.lit(3.0)).alias("pred"))
    path = files.write_predictions(pred, scratch_path(spark, "predictions"), "r1", pred="pred")
    return spark.read.parquet(path)


@query("src_csv_roundtrip", ("SRC-1", "SNK-1"), with_views("""
SELECT row_id, district, heating, deal_type, area, built_year,
       CASE row_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'say "' || hood || '", ' || district WHEN 2 THEN hood || chr(10) || district
                       WHEN 3 THEN NULL ELSE '\\"' END AS note FROM trades
""", "trades"))
def q_csv(spark, sf):
    from ..sources import files
    m = F.col("row_id") % 5
    note = (F.when(m == 0, "").when(m == 1, F.concat(F.lit('say "'), "hood", F.lit('", '), "district"))
            .when(m == 2, F.concat("hood", F.lit("\n"), "district")).when(m == 4, F.lit('\\"')))
    t = views.trades(spark, sf).select("row_id", "district", "heating", "deal_type", "area", "built_year", note.alias("note"))
    return files.csv_roundtrip(t, "trades_csv")


@query("mat_materialize", ("MAT-1", "MAT-2"), with_views("""
SELECT row_id, district, area FROM trades
""", "trades"))
def q_mat(spark, sf):
    from ..sources.store import materialize
    build = lambda: views.trades(spark, sf).select("row_id", "district", "area")
    return materialize(spark, "trades_min", build, source=sf)


@query("eva_residual_study", ("EVA-6", "ENC-3", "SRT-1", "AGG-4"), with_views("""
, ch AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT district AS v FROM trades WHERE is_test = 0)),
m AS (SELECT district, avg(target) AS te FROM trades WHERE is_test = 0 GROUP BY district),
e AS (SELECT t.row_id, ch.code AS district_code, t.target, t.area, (t.target - m.te) * (t.target - m.te) AS se
      FROM trades t JOIN m ON t.district = m.district JOIN ch ON t.district = ch.v WHERE t.is_test = 1),
w AS (SELECT 'worst' AS kind, * FROM e ORDER BY se DESC, row_id LIMIT 100),
b AS (SELECT 'best' AS kind, * FROM e ORDER BY se ASC, row_id LIMIT 100),
x AS (SELECT w.*, ch.v AS district FROM w JOIN ch ON w.district_code = ch.code
      UNION ALL SELECT b.*, ch.v FROM b JOIN ch ON b.district_code = ch.code)
SELECT kind, count(*) AS n, count(DISTINCT district) AS n_districts,
       round(avg(target), 4) AS target_mean, round(min(target), 4) AS target_min, round(max(target), 4) AS target_max,
       round(avg(area), 4) AS area_mean, count(area) AS area_count
FROM x GROUP BY kind
""", "trades"))
def q_residuals(spark, sf):
    t = views.trades(spark, sf).select("row_id", "district", "target", "area", "is_test")
    train, test = t.where("is_test = 0"), t.where("is_test = 1")
    codes = encode.label_codes(train, None, "district")
    means, _ = encode.target_means(train, "district", "target")
    e = encode.apply_target_means(test, "district", means, None, out="pred").where(F.col("pred").isNotNull())
    e = encode.apply_codes(e, "district", codes, out="district_code")
    e = e.withColumn("se", (F.col("target") - F.col("pred")) ** 2)
    worst = e.orderBy(F.desc("se"), "row_id").limit(100).withColumn("kind", F.lit("worst"))
    best = e.orderBy(F.asc("se"), "row_id").limit(100).withColumn("kind", F.lit("best"))
    both = encode.decode(worst.unionByName(best).drop("district"), "district_code", codes, out="district_code") \
                 .withColumnRenamed("district_code", "district")
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("district").alias("n_districts"),
        F.round(F.avg("target"), 4).alias("target_mean"), F.round(F.min("target"), 4).alias("target_min"),
        F.round(F.max("target"), 4).alias("target_max"), F.round(F.avg("area"), 4).alias("area_mean"),
        F.count("area").alias("area_count"))


@query("fil_dedup_report", "FIL-4", """
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS removed
FROM lineitem
""")
def q_dedup_report(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    _, rep = combine.drop_duplicates_report(li)
    return rep
