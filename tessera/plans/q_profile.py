"""Profiling and statistics queries (2.4) and type rules (TYP-2 .. TYP-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pf
from ..operators import schema
from ..sources import views
from ..sources.store import cut_lineage
from ..sources.tables import table
from .registry import query
from .sqltext import with_views

NUM = ["area", "bal", "built_year", "target", "lon", "lat", "contract_day"]
CAT = ["district", "hood", "heating", "deal_type"]
D = 4  # decimals for statistics of large-magnitude columns


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _profile_sql(num, cat, src="trades", d=D):
    parts = []
    for c in [*num, *cat]:
        parts += [
            f"SELECT '{c}' AS column, 'n_missing' AS metric, CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM {src}",
            f"SELECT '{c}', 'pct_missing', round(100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), {d}), NULL FROM {src}",
            f"SELECT '{c}', 'n_unique', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM {src}",
            f"SELECT '{c}', 'pct_unique', round(100e0 * count(DISTINCT {c}) / count(*), {d}), NULL FROM {src}",
        ]
        if c in num:
            parts += [
                f"SELECT '{c}', 'mean', round(avg({c}), {d}), NULL FROM {src}",
                f"SELECT '{c}', 'std', round(stddev_samp({c}), {d}), NULL FROM {src}",
                f"SELECT '{c}', 'min', round(CAST(min({c}) AS DOUBLE), {d}), NULL FROM {src}",
                f"SELECT '{c}', 'max', round(CAST(max({c}) AS DOUBLE), {d}), NULL FROM {src}",
                f"SELECT '{c}', 'n_outliers', CAST(count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS DOUBLE), NULL "
                f"FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})",
                f"SELECT '{c}', 'pct_outliers', round(100e0 * count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) / count(*), {d}), NULL "
                f"FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})",
            ]
        else:
            mode = (f"(SELECT v, n FROM (SELECT {c} AS v, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY 1) "
                    f"ORDER BY n DESC, v LIMIT 1)")
            parts += [
                f"SELECT '{c}', 'mode', CAST(NULL AS DOUBLE), v FROM {mode}",
                f"SELECT '{c}', 'pct_mode', round(100e0 * n / (SELECT count(*) FROM {src}), {d}), NULL FROM {mode}",
            ]
    return _union(parts)


@query("agg_profile", ("AGG-1", "TYP-1"), with_views(_profile_sql(NUM, CAT), "trades"))
def q_profile(spark, sf):
    t = cut_lineage(views.trades(spark, sf).select(*NUM, *CAT), "profile")  # read by several aggregations
    num, cat = schema.numeric_categorical(t)
    return pf.profile(t, num, cat, digits=D)


def _profile_diff_sql():
    before = _profile_sql(["area", "built_year"], [], "trades")
    after = _profile_sql(["area", "built_year"], [], "filled")
    return with_views(f"""
, filled AS (SELECT * REPLACE (coalesce(area, avg(area) OVER ()) AS area,
                               coalesce(built_year, CAST(trunc(avg(built_year) OVER ()) AS BIGINT)) AS built_year) FROM trades),
b AS ({before}), a AS ({after})
SELECT b.column, b.metric, b.value AS before, a.value AS after, round(a.value - b.value, {D}) AS change
FROM b JOIN a ON b.column = a.column AND b.metric = a.metric
""", "trades")


@query("agg_profile_compare", "AGG-2", _profile_diff_sql())
def q_profile_diff(spark, sf):
    t = views.trades(spark, sf).select("area", "built_year")
    m = t.agg(F.avg("area").alias("ma"), F.avg("built_year").cast("bigint").alias("mb"))
    filled = t.crossJoin(F.broadcast(m)).select(F.coalesce("area", "ma").alias("area"),
                                                F.coalesce("built_year", "mb").alias("built_year"))
    b = pf.profile(t, ["area", "built_year"], [], digits=D)
    a = pf.profile(filled, ["area", "built_year"], [], digits=D)
    return b.alias("b").join(a.alias("a"), ["column", "metric"]).select(
        "column", "metric", F.col("b.value").alias("before"), F.col("a.value").alias("after"),
        F.round(F.col("a.value") - F.col("b.value"), D).alias("change"))


@query("agg_missing_report", "AGG-3", with_views(_union([
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"round(100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS pct_missing FROM trades"
    for c in [*NUM, *CAT, "mostly_null"]]), "trades"))
def q_missing(spark, sf):
    return pf.missing_report(views.trades(spark, sf), [*NUM, *CAT, "mostly_null"])


def _describe_sql(cols, src="trades"):
    parts = []
    for c in cols:
        parts += [f"SELECT '{c}' AS column, 'count' AS stat, CAST(count({c}) AS DOUBLE) AS value FROM {src}",
                  f"SELECT '{c}', 'mean', round(avg({c}), {D}) FROM {src}",
                  f"SELECT '{c}', 'std', round(stddev_samp({c}), {D}) FROM {src}",
                  f"SELECT '{c}', 'min', round(CAST(min({c}) AS DOUBLE), {D}) FROM {src}",
                  f"SELECT '{c}', 'max', round(CAST(max({c}) AS DOUBLE), {D}) FROM {src}"]
        for p in pf.DESCRIBE_PCTS:
            parts.append(f"SELECT '{c}', 'p{int(round(p * 100))}', round(quantile_cont({c}, {p}), {D}) FROM {src}")
    return _union(parts)


@query("agg_describe", "AGG-4", with_views(_describe_sql(["area", "built_year", "target"]), "trades"))
def q_describe(spark, sf):
    return pf.describe(views.trades(spark, sf), ["area", "built_year", "target"], digits=D)


@query("agg_value_counts", "AGG-5", with_views("""
SELECT heating AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 8) AS share
FROM trades WHERE heating IS NOT NULL GROUP BY heating
""", "trades"))
def q_value_counts(spark, sf):
    return pf.value_counts(views.trades(spark, sf), "heating")


@query("agg_iqr_outliers", "AGG-6", with_views(_union([
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS n_outliers "
    f"FROM trades, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM trades)"
    for c in NUM]), "trades"))
def q_outliers(spark, sf):
    return pf.iqr_outlier_counts(views.trades(spark, sf), NUM)


CORR = ["area", "bal", "built_year", "target", "contract_day"]


@query("agg_corr_pairs", "AGG-7", with_views(_union([
    f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 8) AS r FROM trades"
    for i, a in enumerate(CORR) for b in CORR[i + 1:]]), "trades"))
def q_corr(spark, sf):
    return pf.corr_pairs(views.trades(spark, sf), CORR)


@query("agg_corr_target", ("AGG-8", "SEL-10"), with_views(_union([
    f"SELECT '{c}' AS column, round(corr(CAST({c} AS DOUBLE), target), 8) AS r FROM trades"
    for c in ["area", "bal", "built_year", "contract_day"]]), "trades"))
def q_corr_target(spark, sf):
    return pf.corr_with_target(views.trades(spark, sf), ["area", "bal", "built_year", "contract_day"], "target")


SPEAR = ["bal", "target", "contract_day", "contract_ym"]


def _spearman_sql():
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS r_{c}" for c in SPEAR)
    pairs = [f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr(r_{a}, r_{b}), 8) AS rho FROM rk"
             for i, a in enumerate(SPEAR) for b in SPEAR[i + 1:]]
    return with_views(f", rk AS (SELECT {ranks} FROM trades)\n" + _union(pairs), "trades")


@query("agg_spearman", "AGG-9", _spearman_sql())
def q_spearman(spark, sf):
    return pf.spearman_pairs(views.trades(spark, sf), SPEAR)


GAPS = ["area", "lat", "mostly_null", "built_year", "target"]


def _spearman_gaps_sql():
    """Each pair ranked over the rows that have both."""
    parts = []
    for a, b in ((a, b) for i, a in enumerate(GAPS) for b in GAPS[i + 1:]):
        ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS r{k}" for k, c in enumerate((a, b)))
        rho = "CASE WHEN stddev_pop(r0) > 0 AND stddev_pop(r1) > 0 THEN round(corr(r0, r1), 8) END"
        parts.append(f"SELECT '{a}' AS c1, '{b}' AS c2, {rho} AS rho FROM (SELECT {ranks} FROM trades WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return with_views(_union(parts), "trades")


@query("agg_spearman_gaps", "AGG-9", _spearman_gaps_sql())
def q_spearman_gaps(spark, sf):
    return pf.spearman_pairs(views.trades(spark, sf), GAPS)


@query("agg_group_mean_std", ("AGG-10", "AGG-11"), with_views("""
SELECT district, hood, count(*) AS n, round(avg(target), 2) AS mean, round(stddev_samp(target), 2) AS std
FROM trades GROUP BY district, hood
""", "trades"))
def q_group_stats(spark, sf):
    return pf.group_stats(views.trades(spark, sf), ["district", "hood"], "target")


@query("agg_repeated_keys", "AGG-12", """
SELECT CAST(sum(n - 1) AS BIGINT) AS repeated, count(*) AS distinct_keys
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
""")
def q_repeated(spark, sf):
    return pf.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("agg_split_sanity", "AGG-13", with_views("""
SELECT is_test, count(*) AS rows, count(*) FILTER (WHERE target IS NULL) AS target_nulls, CAST(17 AS BIGINT) AS n_columns
FROM trades GROUP BY is_test
""", "trades"))
def q_sanity(spark, sf):
    return pf.split_sanity(views.trades(spark, sf))


@query("agg_histogram", "AGG-14", with_views("""
SELECT CAST(least(floor((target - lo) / ((hi - lo) / 30e0)), 29) AS BIGINT) AS bin, count(*) AS count
FROM trades, (SELECT min(target) AS lo, max(target) AS hi FROM trades) GROUP BY 1
""", "trades"))
def q_hist(spark, sf):
    return pf.histogram(views.trades(spark, sf), "target", 30)


@query("agg_box_numbers", "AGG-14", with_views("""
, q AS (SELECT quantile_cont(area, 0.0) AS mn, quantile_cont(area, 0.25) AS q1, quantile_cont(area, 0.5) AS med,
               quantile_cont(area, 0.75) AS q3, quantile_cont(area, 1.0) AS mx FROM trades)
SELECT 'area' AS column, s.stat, round(s.value, 6) AS value FROM (
  SELECT 'min' AS stat, mn AS value FROM q UNION ALL SELECT 'q1', q1 FROM q UNION ALL SELECT 'median', med FROM q
  UNION ALL SELECT 'q3', q3 FROM q UNION ALL SELECT 'max', mx FROM q
  UNION ALL SELECT 'whisker_low', (SELECT min(area) FROM trades, q WHERE area >= q1 - 1.5 * (q3 - q1))
  UNION ALL SELECT 'whisker_high', (SELECT max(area) FROM trades, q WHERE area <= q3 + 1.5 * (q3 - q1))) s
""", "trades"))
def q_box(spark, sf):
    return pf.box_numbers(views.trades(spark, sf), "area")


@query("agg_top10_categories", "AGG-15", with_views(_union([
    f"SELECT * FROM (SELECT '{c}' AS column, {c} AS value, count(*) AS count, "
    f"row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank FROM trades WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 10"
    for c in ["district", "hood", "heating", "complex"]]), "trades"))
def q_top10(spark, sf):
    t = views.trades(spark, sf)
    return pf.top_categories(t, ["district", "hood", "heating", "complex"], 10) \
             .select("column", "value", "count", F.col("rank").cast("bigint").alias("rank"))


@query("agg_train_test_compare", "AGG-16", with_views(_union([
    f"SELECT '{c}' AS column, round(avg({c}) FILTER (WHERE is_test = 0), {D}) AS mean_train, "
    f"round(avg({c}) FILTER (WHERE is_test = 1), {D}) AS mean_test, "
    f"round(100e0 * count(*) FILTER (WHERE is_test = 0 AND {c} IS NULL) / count(*) FILTER (WHERE is_test = 0), {D}) AS pct_missing_train, "
    f"round(100e0 * count(*) FILTER (WHERE is_test = 1 AND {c} IS NULL) / count(*) FILTER (WHERE is_test = 1), {D}) AS pct_missing_test "
    f"FROM trades" for c in ["area", "bal", "built_year"]]), "trades"))
def q_train_test(spark, sf):
    t = views.trades(spark, sf)
    cols = ["area", "bal", "built_year"]
    tr, te = F.col("is_test") == 0, F.col("is_test") == 1
    wide = t.agg(F.count_if(tr).alias("n0"), F.count_if(te).alias("n1"),
                 *[F.avg(F.when(tr, F.col(c))).alias(f"m0_{c}") for c in cols],
                 *[F.avg(F.when(te, F.col(c))).alias(f"m1_{c}") for c in cols],
                 *[F.count_if(tr & F.col(c).isNull()).alias(f"z0_{c}") for c in cols],
                 *[F.count_if(te & F.col(c).isNull()).alias(f"z1_{c}") for c in cols])
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.round(F.col(f"m0_{c}"), D).alias("mean_train"),
        F.round(F.col(f"m1_{c}"), D).alias("mean_test"),
        F.round(F.col(f"z0_{c}") * 100.0 / F.col("n0"), D).alias("pct_missing_train"),
        F.round(F.col(f"z1_{c}") * 100.0 / F.col("n1"), D).alias("pct_missing_test")) for c in cols]))
    return wide.select(rows.alias("r")).select("r.*")


@query("agg_word_counts_top100", "AGG-17", """
SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM documents) WHERE word <> ''
GROUP BY word ORDER BY count DESC, word LIMIT 100
""")
def q_words(spark, sf):
    return pf.word_counts(table(spark, sf, "documents"), "text", 100)


@query("typ_unique_ratio", "TYP-2", with_views(_union([
    f"SELECT '{c}' AS column, CASE WHEN {'false' if c in CAT else 'true'} AND count(DISTINCT {c}) / count(*) >= 0.05 "
    f"THEN 'continuous' ELSE 'categorical' END AS kind FROM trades" for c in [*NUM, *CAT]]), "trades"))
def q_typ_ratio(spark, sf):
    t = views.trades(spark, sf).select(*NUM, *CAT)
    return pf.categorical_by_ratio(t, 0.05)


@query("typ_rules", "TYP-3", with_views(_union([
    f"SELECT '{c}' AS column, round(-sum(p * ln(p)), 6) AS entropy, round(max(p), 6) AS top_share, "
    f"CASE WHEN count(*) <= 10 OR max(p) > 0.8 OR -sum(p * ln(p)) < 1.0 THEN 'categorical' ELSE 'continuous' END AS kind "
    f"FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM trades WHERE {c} IS NOT NULL GROUP BY {c})"
    for c in ["district", "hood", "heating", "deal_type", "built_year", "contract_day"]]), "trades"))
def q_typ_rules(spark, sf):
    return pf.categorical_by_rules(views.trades(spark, sf),
                                   ["district", "hood", "heating", "deal_type", "built_year", "contract_day"])


def _groups_sql():
    parts = []
    for c in [*NUM, *CAT, "mostly_null"]:
        numeric = c in NUM or c == "mostly_null"
        parts.append(
            f"SELECT '{c}' AS column, CASE WHEN count(*) FILTER (WHERE {c} IS NULL) / count(*) > 0.5 THEN 'high_missing' "
            f"WHEN count(DISTINCT {c}) + CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END = 2 THEN 'binary' "
            f"WHEN {str(numeric).lower()} AND count(DISTINCT {c}) / count(*) > 0.05 THEN 'continuous' "
            f"WHEN {str(numeric).lower()} THEN 'discrete' "
            f"WHEN count(DISTINCT {c}) > 10 THEN 'high_cardinality_cat' ELSE 'low_cardinality_cat' END AS \"group\" FROM trades")
    return with_views(_union(parts), "trades")


@query("typ_feature_groups", "TYP-4", _groups_sql())
def q_groups(spark, sf):
    return pf.feature_groups(views.trades(spark, sf).select(*NUM, *CAT, "mostly_null"))


@query("agg_quality_flags", ("AGG-18", "AGG-19"), with_views(f"""
, pairs AS ({_union([f"SELECT '{a}' AS c1, '{b}' AS c2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM trades"
                     for i, a in enumerate(CORR) for b in CORR[i + 1:]])}),
bothp AS (SELECT c1 AS column, abs(r) AS ar FROM pairs UNION ALL SELECT c2, abs(r) FROM pairs),
o AS ({_union([f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) > 0 AS has_missing, "
               f"count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) > 0 AS has_outliers "
               f"FROM trades, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM trades)" for c in CORR])})
SELECT o.column, o.has_missing, o.has_outliers, max(b.ar) > 0.8 AS high_corr, round(max(b.ar), 8) AS max_abs_corr
FROM o JOIN bothp b ON o.column = b.column GROUP BY o.column, o.has_missing, o.has_outliers
""", "trades"))
def q_quality(spark, sf):
    t = views.trades(spark, sf)
    pairs = pf.corr_pairs(t, CORR, digits=16)
    both = pairs.select(F.col("c1").alias("column"), F.abs("r").alias("ar")) \
                .unionByName(pairs.select(F.col("c2").alias("column"), F.abs("r").alias("ar")))
    mx = both.groupBy("column").agg(F.max("ar").alias("mx"))
    miss = pf.missing_report(t, CORR)
    outl = pf.iqr_outlier_counts(t, CORR)
    return (miss.join(outl, "column").join(mx, "column")
            .select("column", (F.col("n_missing") > 0).alias("has_missing"), (F.col("n_outliers") > 0).alias("has_outliers"),
                    (F.col("mx") > 0.8).alias("high_corr"), F.round("mx", 8).alias("max_abs_corr")))


@query("agg_top_corr_pairs", "AGG-19", with_views(f"""
SELECT c1, c2, round(r, 8) AS r FROM ({_union([f"SELECT '{a}' AS c1, '{b}' AS c2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM trades"
                                      for i, a in enumerate(CORR) for b in CORR[i + 1:]])})
ORDER BY abs(r) DESC, c1, c2 LIMIT 5
""", "trades"))
def q_top_pairs(spark, sf):
    p = pf.corr_pairs(views.trades(spark, sf), CORR, digits=16)
    return p.orderBy(F.abs("r").desc(), "c1", "c2").limit(5).select("c1", "c2", F.round("r", 8).alias("r"))
