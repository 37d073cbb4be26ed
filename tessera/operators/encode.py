"""Category encoders (ENC-1 .. ENC-7).

Fitted state is a mapping DataFrame ``(value, code)`` per column, never a
driver dict of categories.  Codes of sorted distinct values come from
``with_position`` (range buckets + offsets), so no single-partition window is
needed even for very many categories.  Mapping joins are plain equi-joins:
AQE turns them into broadcast joins when the mapping is small at run time
and splits skewed fact partitions otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..sources.store import cut_lineage
from .ordering import with_position

NULL_LABEL = "NULL"
OTHER = "OTHER"


def _as_text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL))


def label_codes(train: DataFrame, test: DataFrame | None, col: str) -> DataFrame:
    """ENC-1 fit: sorted distinct train values -> 0..n-1; values seen only in
    ``test`` follow in sorted order, each with its own code.  Null is the
    label 'NULL'.  Returns ``(value, code)``.  Each side is read once: its distinct
    values are written before they are counted, dealt and ordered."""
    tr = cut_lineage(train.select(_as_text(col).alias("value")).distinct(), "label_values")
    tr_codes = with_position(tr, "value", "code")
    if test is None:
        return tr_codes
    n = tr.count()
    new = cut_lineage(test.select(_as_text(col).alias("value")).distinct().join(tr, "value", "left_anti"), "label_values")
    new_codes = with_position(new, "value", "code").withColumn("code", F.col("code") + F.lit(n))
    return tr_codes.unionByName(new_codes)


def apply_codes(df: DataFrame, col: str, codes: DataFrame, out: str | None = None,
                default=None) -> DataFrame:
    """Replace ``col`` by its code (left join; unmatched -> ``default``)."""
    out = out or col
    m = codes.select(F.col("value").alias("_v"), F.col("code").alias("_c"))
    j = df.withColumn("_v", _as_text(col)).join(m, "_v", "left")
    code = F.col("_c") if default is None else F.coalesce(F.col("_c"), F.lit(default))
    if out == col:
        return j.select(*[code.alias(out) if c == col else F.col(c) for c in df.columns])
    return j.select(*[F.col(c) for c in df.columns], code.alias(out))


def label_encode(train: DataFrame, test: DataFrame, cols: Sequence[str]):
    """ENC-1 on several columns: returns (train_enc, test_enc, {col: codes}).  All codes are
    fitted on the rows as given and written once; both sides read them."""
    maps = {c: cut_lineage(label_codes(train, test, c), "label_codes") for c in cols}
    for c, codes in maps.items():
        train = apply_codes(train, c, codes)
        test = apply_codes(test, c, codes)
    return train, test, maps


def label_encode_union(df: DataFrame, cols: Sequence[str], unknown: str = "Unknown"):
    """ENC-2: fill 'Unknown', fit codes on all rows (train and test together)."""
    df = df.na.fill(unknown, subset=list(cols))
    maps = {}
    for c in cols:
        codes = label_codes(df, None, c)
        maps[c] = codes
        df = apply_codes(df, c, codes)
    return df, maps


def decode(df: DataFrame, col: str, codes: DataFrame, out: str | None = None) -> DataFrame:
    """ENC-3: code back to its label."""
    out = out or col
    m = codes.select(F.col("code").alias("_c"), F.col("value").alias("_lab"))
    j = df.join(m, df[col] == m["_c"], "left")
    return j.select(*[F.col("_lab").alias(out) if c == col else df[c] for c in df.columns])


def min_frequency(df: DataFrame, col: str, base: float = 0.05, strategy: str = "percentile") -> int:
    """ENC-4: minimum count for a category to keep its own code.

    ``percentile``: the ``base`` quantile of the per-value counts (nulls not
    counted); ``fixed``: ``base`` x row count.  Floored, at least 1.
    """
    if strategy == "percentile":
        counts = df.where(F.col(col).isNotNull()).groupBy(col).count()
        v = quantiles(counts, ["count"], [base])[("count", base)]
        v = 0.0 if v is None else v
    elif strategy == "fixed":
        v = df.count() * base
    else:
        raise ValueError(strategy)
    return max(1, int(math.floor(v)))


def min_frequencies(df: DataFrame, cols: Sequence[str], base: float = 0.05) -> DataFrame:
    """ENC-4 for many columns and both strategies: (column, strategy, min_freq)
    from one count of all columns' values; the quantile is read off the
    number of values that have each count, with linear interpolation."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    counts = cut_lineage(df.select(pairs.alias("x")).select("x.*").groupBy("column", "value").count()
                         .groupBy("column", F.col("value").isNull().alias("missing"), F.col("count").alias("n"))
                         .agg(F.count(F.lit(1)).alias("values")), "min_frequency")
    own = Window.partitionBy("column").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    known = counts.where("not missing")
    total = known.groupBy("column").agg(F.sum("values").alias("total")).withColumn("h", (F.col("total") - 1) * base)
    ranked = known.withColumn("upto", F.sum("values").over(own)).join(total, "column")
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("n")))
    low, high = F.floor("h"), F.least(F.floor("h") + 1, F.col("total") - 1)
    q = (ranked.groupBy("column").agg(at(low).alias("a"), at(high).alias("b"), F.first("h").alias("h"))
         .select("column", F.lit("percentile").alias("strategy"), (F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h"))).alias("v")))
    fixed = counts.groupBy("column").agg((F.sum(F.col("n") * F.col("values")) * base).alias("v")).select("column", F.lit("fixed").alias("strategy"), "v")
    return q.unionByName(fixed).select("column", "strategy", F.greatest(F.lit(1), F.floor("v")).cast("bigint").alias("min_freq"))


def rare_codes(train: DataFrame, col: str, min_count: int) -> tuple[DataFrame, DataFrame]:
    """ENC-5 fit: values with train count >= ``min_count`` keep their label,
    others (and null) become 'OTHER'; codes over sorted labels.

    Returns (frequent values, (value, code) mapping)."""
    counts = train.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).count()
    frequent = counts.where(F.col("count") >= min_count).select("value")
    labels = train.select(F.col(col).cast("string").alias("value")).join(
        frequent.withColumn("_keep", F.lit(True)), "value", "left") \
        .select(F.when(F.col("_keep"), F.col("value")).otherwise(F.lit(OTHER)).alias("value")).distinct()
    return frequent, with_position(labels, "value", "code")


def apply_rare(df: DataFrame, col: str, frequent: DataFrame, codes: DataFrame, out: str | None = None) -> DataFrame:
    """ENC-5 apply: unseen or rare -> 'OTHER' -> its code (null if train had no 'OTHER')."""
    out = out or col
    f = frequent.select(F.col("value").alias("_v"), F.lit(True).alias("_keep"))
    m = codes.select(F.col("value").alias("_lab"), F.col("code").alias("_code"))
    j = (df.withColumn("_v", F.col(col).cast("string")).join(f, "_v", "left")
         .withColumn("_lab", F.when(F.col("_keep"), F.col("_v")).otherwise(F.lit(OTHER)))
         .join(m, "_lab", "left"))
    cols = [F.col("_code").alias(out) if c == col else F.col(c) for c in df.columns]
    if out != col:
        cols = [F.col(c) for c in df.columns] + [F.col("_code").alias(out)]
    return j.select(*cols)


def target_means(train: DataFrame, col: str, target: str) -> tuple[DataFrame, float | None]:
    """ENC-6 fit: mean target per category (null keys excluded) and the global mean."""
    return _category_means(train, col, target), train.agg(F.avg(target)).first()[0]


def _category_means(train: DataFrame, col: str, target: str) -> DataFrame:
    return train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.avg(target).alias("te"))


def apply_target_means(df: DataFrame, col: str, means: DataFrame, default: float | None,
                       out: str | None = None) -> DataFrame:
    """ENC-6 apply: category -> train mean; unmatched -> ``default`` (pass
    ``None`` for train rows, the global mean for test rows)."""
    out = out or col
    m = means.select(F.col("value").alias("_tv"), F.col("te").alias("_te"))
    j = df.join(m, df[col] == m["_tv"], "left")
    val = F.col("_te") if default is None else F.coalesce(F.col("_te"), F.lit(default))
    if out == col:
        return j.select(*[val.alias(c) if c == col else df[c] for c in df.columns])
    return j.select(*[df[c] for c in df.columns], val.alias(out))


def target_encode(train: DataFrame, test: DataFrame, cols: Sequence[str], target: str, written: bool = False):
    """ENC-6 over several columns (train rows keep their own mean, Q18).  All means are
    fitted on the rows as given, the global one once.  ``written``: each column's means are
    written and both sides read them, so small ones are broadcast by their size and the
    rows are not shuffled for them."""
    g = train.agg(F.avg(target)).first()[0] if cols else None
    maps = {c: _category_means(train, c, target) for c in cols}
    if written:
        maps = {c: cut_lineage(means, "target_means") for c, means in maps.items()}
    for c, means in maps.items():
        train = apply_target_means(train, c, means, None)
        test = apply_target_means(test, c, means, g)
    return train, test


def frequency_encode(train: DataFrame, test: DataFrame, cols: Sequence[str]):
    """Each value becomes its count in train, 0 if it has none; null counts as a value.
    The counts are written once; both sides read them."""
    maps = {c: cut_lineage(train.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "frequencies") for c in cols}
    for c, counts in maps.items():
        train, test = (d.join(counts, d[c].eqNullSafe(counts["_v"]), "left")
                       .select(*[F.coalesce(F.col("_n"), F.lit(0)).cast("double").alias(c) if x == c else F.col(x) for x in d.columns])
                       for d in (train, test))
    return train, test


def one_hot(train: DataFrame, df: DataFrame, col: str, prefix: str | None = None, most: int = 2000) -> DataFrame:
    """ENC-7: one 0/1 column per train category; unknown values get all zeros.
    The output is as wide as the train table has categories; more than ``most`` are an
    error, and a case for ``one_hot_long``, which has them as rows."""
    prefix = prefix or col
    levels = sorted(r[0] for r in train.where(F.col(col).isNotNull()).select(col).distinct().take(most + 1))
    if len(levels) > most:
        raise ValueError(f"{col} has more than {most} categories: use one_hot_long")
    return df.select("*", *[F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int").alias(f"{prefix}_{v}")
                            for v in levels])


def one_hot_long(train: DataFrame, df: DataFrame, col: str, key: str = "row_id") -> DataFrame:
    """ENC-7, sparse form: (key, level) for each row whose value is a train
    category; any number of categories, none on the driver."""
    levels = train.where(F.col(col).isNotNull()).select(F.col(col).alias("level")).distinct()
    return df.select(key, F.col(col).alias("level")).join(levels, "level").select(key, "level")


def target_means_oof(df: DataFrame, col: str, target: str, fold: str = "fold", out: str | None = None) -> DataFrame:
    """ENC-6 option: out-of-fold target means (a row never sees its own fold),
    from one aggregation by (category, fold): (S_c - S_cf) / (N_c - N_cf).
    A category seen only in the row's own fold gets the out-of-fold global mean."""
    out = out or f"{col}_te"
    cf = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_c"), F.col(fold).alias("_f")) \
           .agg(F.sum(target).alias("s_cf"), F.count(F.lit(1)).alias("n_cf"))
    c = cf.groupBy("_c").agg(F.sum("s_cf").alias("s_c"), F.sum("n_cf").alias("n_c"))
    per_fold = df.groupBy(fold).agg(F.sum(target).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # one row per fold
    s_all, n_all = sum(r["s"] for r in per_fold), sum(r["n"] for r in per_fold)
    glob = df.sparkSession.createDataFrame(
        [(r[fold], (s_all - r["s"]) / (n_all - r["n"]) if n_all > r["n"] else None) for r in per_fold],
        f"_f {dict(df.dtypes)[fold]}, _g double")
    m = cf.join(c, "_c").where(F.col("n_c") > F.col("n_cf")) \
          .select("_c", "_f", ((F.col("s_c") - F.col("s_cf")) / (F.col("n_c") - F.col("n_cf"))).alias("_m"))
    j = df.join(m, (df[col] == m["_c"]) & (df[fold] == m["_f"]), "left").drop("_c", "_f") \
          .join(F.broadcast(glob), df[fold] == glob["_f"], "left")
    return j.select(*[df[x] for x in df.columns], F.coalesce(F.col("_m"), F.col("_g")).alias(out))
