"""Aggregation and profiling (AGG-*, TYP-2 .. TYP-4).

Shapes used throughout:

* one *wide* aggregation computes every per-column moment at once;
* one *long* value-count table ``(column, value, count)`` built by exploding
  each row into (column, value) pairs and counting with partial aggregation;
  it yields distinct counts, modes, shares, entropy and top-k per column
  without a per-column pass and without a count-distinct expansion;
* exact quantiles come from ``functions.quantiles`` (distributed selection).

Results are long tables ``(column, metric, value)``, never driver dicts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import quantiles
from ..sources.store import cut_lineage
from .ordering import range_buckets


def value_counts_long(df: DataFrame, cols: Sequence[str], keep_null: bool = False) -> DataFrame:
    """(column, value, count) for every listed column; value as text."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                for c in cols])).alias("p")
    long = df.select(pairs).select("p.column", "p.value")
    if not keep_null:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column", "value").count()


def top_k_per_group(df: DataFrame, group: str, order: list, k: int, salt_buckets: int = 64,
                    salt_col: str | None = None) -> DataFrame:
    """Top ``k`` rows per group in two steps: top k inside (group, salt)
    buckets, then top k over at most k x buckets candidates per group, so a
    group with very many rows is never ranked inside one task."""
    salt = F.abs(F.xxhash64(F.col(salt_col))) % salt_buckets if salt_col else F.abs(F.xxhash64(*df.columns)) % salt_buckets
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    w2 = Window.partitionBy(group).orderBy(*order)
    cand = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    return cand.drop("_salt", "_r").withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def _long(rows: list[tuple], spark) -> DataFrame:
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("metric", T.StringType()),
                           T.StructField("value", T.DoubleType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(rows, schema)


def profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], digits: int = 6) -> DataFrame:
    """AGG-1: per column missing / unique counts and %, numeric mean, sample
    std, min, max and 1.5 IQR outliers, categorical mode and its %.

    The scalars are computed by Spark in three aggregations and returned as
    one long table (row count = columns x metrics)."""
    cols = [*numeric, *categorical]
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"miss_{c}") for c in cols],
                  *[F.avg(c).alias(f"mean_{c}") for c in numeric],
                  *[F.stddev_samp(c).alias(f"std_{c}") for c in numeric],
                  *[F.min(c).cast("double").alias(f"min_{c}") for c in numeric],
                  *[F.max(c).cast("double").alias(f"max_{c}") for c in numeric]).first()
    n = wide["__n"]
    counts = value_counts_long(df, cols)
    per_col = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("value", "count"), F.struct((-F.col("count")).alias("a"), F.col("value").alias("b"))).alias("m")
    ).collect()  # one row per column
    uniq = {r["column"]: r["n"] for r in per_col}
    modes = {r["column"]: (r["m"]["value"], r["m"]["count"]) for r in per_col if r["column"] in set(categorical)}
    q = quantiles(df, list(numeric), [0.25, 0.75]) if numeric else {}
    out_aggs = []
    for c in numeric:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            out_aggs.append(F.lit(0).alias(f"o_{c}"))
            continue
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        out_aggs.append(F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(f"o_{c}"))
    orow = df.agg(*out_aggs).first() if out_aggs else None

    def r(x):
        return None if x is None else round(float(x), digits)

    rows = []
    for c in cols:
        miss, u = wide[f"miss_{c}"], uniq.get(c, 0)
        rows += [(c, "n_missing", float(miss), None), (c, "pct_missing", r(100.0 * miss / n) if n else None, None),
                 (c, "n_unique", float(u), None), (c, "pct_unique", r(100.0 * u / n) if n else None, None)]
        if c in numeric:
            o = orow[f"o_{c}"]
            rows += [(c, "mean", r(wide[f"mean_{c}"]), None), (c, "std", r(wide[f"std_{c}"]), None),
                     (c, "min", r(wide[f"min_{c}"]), None), (c, "max", r(wide[f"max_{c}"]), None),
                     (c, "n_outliers", float(o), None), (c, "pct_outliers", r(100.0 * o / n) if n else None, None)]
        else:
            m, mc = modes.get(c, (None, None))
            rows += [(c, "mode", None, m), (c, "pct_mode", r(100.0 * mc / n) if mc is not None and n else None, None)]
    return _long(rows, df.sparkSession)


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-3: (column, n_missing, pct_missing) via one aggregation + stack."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in cols]))
    return wide.select(F.col("__n"), pairs.alias("p")).select(
        "p.column", "p.n_missing", F.round(F.col("p.n_missing") * 100.0 / F.col("__n"), 6).alias("pct_missing"))


DESCRIBE_PCTS = (0.1, 0.25, 0.5, 0.75, 0.8, 0.9)


def describe(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = DESCRIBE_PCTS,
             digits: int = 6) -> DataFrame:
    """AGG-4: count, mean, std, min, custom exact percentiles, max (long)."""
    wide = df.agg(*[F.count(c).alias(f"count_{c}") for c in cols], *[F.avg(c).alias(f"mean_{c}") for c in cols],
                  *[F.stddev_samp(c).alias(f"std_{c}") for c in cols],
                  *[F.min(c).cast("double").alias(f"min_{c}") for c in cols],
                  *[F.max(c).cast("double").alias(f"max_{c}") for c in cols]).first()
    q = quantiles(df, list(cols), list(percentiles))
    rows = []
    for c in cols:
        def r(x):
            return None if x is None else round(float(x), digits)
        rows += [(c, "count", float(wide[f"count_{c}"]), None), (c, "mean", r(wide[f"mean_{c}"]), None),
                 (c, "std", r(wide[f"std_{c}"]), None), (c, "min", r(wide[f"min_{c}"]), None)]
        rows += [(c, f"p{int(round(p * 100))}", r(q[(c, p)]), None) for p in percentiles]
        rows += [(c, "max", r(wide[f"max_{c}"]), None)]
    return _long(rows, df.sparkSession).drop("text").withColumnRenamed("metric", "stat")


def value_counts(df: DataFrame, col: str, normalize: bool = True) -> DataFrame:
    """AGG-5: counts per value (nulls excluded) and share of non-null rows."""
    c = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count()
    if not normalize:
        return c
    tot = df.where(F.col(col).isNotNull()).count()
    return c.select("value", "count", F.round(F.col("count") / F.lit(float(tot)), 8).alias("share"))


def iqr_outlier_counts(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """AGG-6: number of values outside Q1 - k IQR .. Q3 + k IQR per column."""
    q = quantiles(df, list(cols), [0.25, 0.75])
    aggs = []
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            aggs.append(F.lit(0).cast("bigint").alias(c))
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        aggs.append(F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(c))
    wide = df.agg(*aggs)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_outliers")) for c in cols]))
    return wide.select(pairs.alias("p")).select("p.column", "p.n_outliers")


def pearson(a: str, b: str):
    """Pearson's r over the rows that have both; null where a side has no spread."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_pairs(df: DataFrame, cols: Sequence[str], digits: int = 8) -> DataFrame:
    """AGG-7: Pearson r of every column pair (c1 before c2), one aggregation.

    Rows with a null in either column are skipped per pair (pairwise
    complete), as pandas ``corr``; r is null where a column has no spread."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[pearson(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.explode(F.array(*[F.struct(F.lit(a).alias("c1"), F.lit(b).alias("c2"), F.col(f"{i}").alias("r"))
                              for i, (a, b) in enumerate(pairs)]))
    return wide.select(arr.alias("p")).select("p.c1", "p.c2", F.round("p.r", digits).alias("r"))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str, digits: int = 8) -> DataFrame:
    """AGG-8: r of each column with the target, sorted by r descending."""
    wide = df.agg(*[pearson(c, target).alias(c) for c in cols])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in cols]))
    return wide.select(arr.alias("p")).select("p.column", F.round("p.r", digits).alias("r")).orderBy(F.desc("r"))


def spearman_pairs(df: DataFrame, cols: Sequence[str], digits: int = 8) -> DataFrame:
    """AGG-9: Spearman's rho of every column pair (c1 before c2) over the rows that
    both columns have, as pandas does: average ranks for ties, null where a side has
    no spread.

    All pairs go through one plan.  Rows become (pair, x, y) counts; the values of each
    (pair, side) are ordered by the range buckets of ``ordering``, so no window holds a
    column; ranks come from prefix sums of counts, one row a (bucket, pair, side)
    between buckets; the correlation is a sum over the counts, weighted."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    x = {c: F.col(c).cast("double") for c in cols}
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), x[a].alias("x"), x[b].alias("y")) for i, (a, b) in enumerate(pairs)]))
    joint = df.select(each.alias("e")).select("e.*").where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    joint = cut_lineage(joint.groupBy("p", "x", "y").agg(F.count(F.lit(1)).alias("n")), "spearman_joint")
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(s).alias("v")) for s in ("x", "y")]))
    values = (joint.select("p", "n", sides.alias("e")).groupBy(F.struct("p", "e.s", "e.v").alias("k")).agg(F.sum("n").alias("n")))
    buckets, _ = range_buckets(values, "k")
    buckets = buckets.select("_bucket", "k.p", "k.s", "k.v", "n")
    before = Window.partitionBy("p", "s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (buckets.groupBy("_bucket", "p", "s").agg(F.sum("n").alias("bn"))
               .select("_bucket", "p", "s", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("off")))
    own = Window.partitionBy("_bucket", "p", "s").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranks = (buckets.withColumn("upto", F.sum("n").over(own)).join(F.broadcast(offsets), ["_bucket", "p", "s"])  # buckets x pairs rows
             .select("p", "s", "v", (F.col("off") + F.col("upto") - (F.col("n") - 1) / 2.0).alias("r")))
    ranks = cut_lineage(ranks, "spearman_ranks")
    rx, ry = (ranks.where(F.col("s") == s).select("p", F.col("v").alias(s), F.col("r").alias(f"r{s}")) for s in ("x", "y"))
    total = joint.groupBy("p").agg(F.sum("n").alias("m"))
    # ranks have the mean (m + 1) / 2 on both sides
    d = joint.join(rx, ["p", "x"]).join(ry, ["p", "y"]).join(F.broadcast(total), "p")
    dx, dy = (F.col(c) - (F.col("m") + 1) / 2.0 for c in ("rx", "ry"))
    s = d.groupBy("p").agg(*[F.sum(F.col("n") * a * b).alias(name) for name, a, b in (("xy", dx, dy), ("xx", dx, dx), ("yy", dy, dy))])
    rho = F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy")))
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "p int, c1 string, c2 string")
    return names.join(s, "p", "left").select("c1", "c2", F.round(rho, digits).alias("rho"))


def group_stats(df: DataFrame, keys: Sequence[str], col: str, digits: int = 2) -> DataFrame:
    """AGG-10 / AGG-11: group mean and sample std, rounded."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(col), digits).alias("mean"),
                                 F.round(F.stddev_samp(col), digits).alias("std"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-12: number of rows whose key already appeared (sum of count - 1)."""
    return df.groupBy(*keys).count().agg(F.sum(F.col("count") - 1).cast("bigint").alias("repeated"),
                                         F.count(F.lit(1)).alias("distinct_keys"))


def split_sanity(df: DataFrame, flag: str = "is_test", target: str = "target") -> DataFrame:
    """AGG-13: rows, target nulls and column count per split."""
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("rows"),
                                F.count_if(F.col(target).isNull()).alias("target_nulls"),
                                F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """AGG-14: equal-width bins between min and max (max in the last bin); a
    constant column is one bin, 0, an empty one has none."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if mm["lo"] is None or mm["lo"] == mm["hi"]:
        b = F.lit(0)
    else:
        lo, hi = F.lit(float(mm["lo"])), F.lit(float(mm["hi"]))
        b = F.least(F.floor((F.col(col) - lo) / ((hi - lo) / F.lit(bins))), F.lit(bins - 1))
    return df.where(F.col(col).isNotNull()).groupBy(b.cast("bigint").alias("bin")).count()


def box_numbers(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """AGG-14: five-number summary plus whisker limits (1.5 IQR)."""
    q = quantiles(df, [col], [0.0, 0.25, 0.5, 0.75, 1.0])
    mn, q1, med, q3, mx = (q[(col, p)] for p in (0.0, 0.25, 0.5, 0.75, 1.0))
    if mn is None:  # an empty column has no numbers
        return df.sparkSession.createDataFrame([], "column string, stat string, value double")
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    wl = df.agg(F.min(F.when(F.col(col) >= lo, F.col(col))).alias("a"),
                F.max(F.when(F.col(col) <= hi, F.col(col))).alias("b")).first()
    rows = [(col, k, round(float(v), digits)) for k, v in
            (("min", mn), ("q1", q1), ("median", med), ("q3", q3), ("max", mx),
             ("whisker_low", wl["a"]), ("whisker_high", wl["b"]))]
    return df.sparkSession.createDataFrame(rows, "column string, stat string, value double")


def top_categories(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """AGG-15: k most frequent values per column (ties by value)."""
    counts = value_counts_long(df, cols)
    return top_k_per_group(counts, "column", [F.desc("count"), F.asc("value")], k, salt_col="value")


def word_counts(df: DataFrame, text: str, k: int = 100) -> DataFrame:
    """AGG-17: whitespace tokens of whole texts counted, top ``k`` (ties by word)."""
    words = df.select(F.explode(F.split(F.col(text), r"[ \t\n\r]+")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").count().orderBy(F.desc("count"), F.asc("word")).limit(k)


def entropy_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: distinct count, top share, entropy (nats) from value counts."""
    c = value_counts_long(df, cols)
    tot = c.groupBy("column").agg(F.sum("count").alias("_t"), F.count(F.lit(1)).alias("n_unique"),
                                  F.max("count").alias("_top"))
    j = c.join(tot, "column")
    p = F.col("count") / F.col("_t")
    return j.groupBy("column", "n_unique", "_t", "_top").agg((-F.sum(p * F.ln(p))).alias("entropy")) \
            .select("column", "n_unique", (F.col("_top") / F.col("_t")).alias("top_share"), "entropy")


def categorical_by_ratio(df: DataFrame, ratio: float = 1e-7) -> DataFrame:
    """TYP-2: categorical if non-numeric or distinct/rows < ratio."""
    counts = value_counts_long(df, df.columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    n = df.count()
    kinds = df.sparkSession.createDataFrame(
        [(f.name, isinstance(f.dataType, T.NumericType)) for f in df.schema.fields], "column string, numeric boolean")
    j = kinds.join(counts, "column", "left").fillna({"n_unique": 0})
    cat = (~F.col("numeric")) | (F.col("n_unique") / F.lit(float(n)) < F.lit(ratio))
    return j.select("column", F.when(cat, "categorical").otherwise("continuous").alias("kind"))


def categorical_by_rules(df: DataFrame, cols: Sequence[str], max_unique: int = 10, top_share: float = 0.8,
                         min_entropy: float = 1.0) -> DataFrame:
    """TYP-3: categorical if distinct <= 10, or a value share > 0.8, or entropy < 1 nat."""
    e = entropy_share(df, cols)
    cat = (F.col("n_unique") <= max_unique) | (F.col("top_share") > top_share) | (F.col("entropy") < min_entropy)
    return e.select("column", F.round("entropy", 6).alias("entropy"), F.round("top_share", 6).alias("top_share"),
                    F.when(cat, "categorical").otherwise("continuous").alias("kind"))


def feature_groups(df: DataFrame, high_missing: float = 0.5, continuous_ratio: float = 0.05,
                   high_card: int = 10) -> DataFrame:
    """TYP-4: high_missing / binary / continuous / discrete / high- or
    low-cardinality categorical.  Binary counts null as one more value."""
    n = df.count()
    counts = value_counts_long(df, df.columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    miss = missing_report(df)
    kinds = df.sparkSession.createDataFrame(
        [(f.name, isinstance(f.dataType, T.NumericType)) for f in df.schema.fields], "column string, numeric boolean")
    j = kinds.join(counts, "column", "left").join(miss, "column").fillna({"n_unique": 0})
    uniq_with_null = F.col("n_unique") + F.when(F.col("n_missing") > 0, 1).otherwise(0)
    g = (F.when(F.col("n_missing") / F.lit(float(n)) > high_missing, "high_missing")
         .when(uniq_with_null == 2, "binary")
         .when(F.col("numeric") & (F.col("n_unique") / F.lit(float(n)) > continuous_ratio), "continuous")
         .when(F.col("numeric"), "discrete")
         .when(F.col("n_unique") > high_card, "high_cardinality_cat")
         .otherwise("low_cardinality_cat"))
    return j.select("column", g.alias("group"))
