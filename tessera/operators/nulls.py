"""Null handling (NUL-1 .. NUL-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import quantiles
from ..functions.scalar import inf_to_null
from ..sources.store import cut_lineage
from .ordering import range_buckets

# The sentinel texts the reference treats as missing.
SENTINELS = (" ", "-")


def sentinels_to_null(df: DataFrame, cols: Sequence[str], sentinels=SENTINELS) -> DataFrame:
    """NUL-1: listed sentinel texts become null."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(F.col(c).isin(list(sentinels)), F.lit(None).cast("string")).otherwise(F.col(c)))
    return out


def blank_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NUL-1 (second form): whole columns set to null, type kept."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return out


def null_ratios(df: DataFrame) -> dict[str, tuple[int, int]]:
    """Null count of every column and the row count, in one aggregation."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return {c: (row[c], row["__n"]) for c in df.columns}


def drop_sparse_columns(df: DataFrame, max_ratio: float | None = 0.9, max_count: int | None = None) -> DataFrame:
    """NUL-2: drop columns whose null ratio is > ``max_ratio`` (or count > ``max_count``)."""
    stats = null_ratios(df)
    keep = []
    for c in df.columns:
        nulls, n = stats[c]
        if max_ratio is not None and n and nulls / n > max_ratio:
            continue
        if max_count is not None and nulls > max_count:
            continue
        keep.append(c)
    return df.select(*keep)


# --------------------------------------------------------------------------
# NUL-3: linear interpolation in global row order, distributed in two passes.
# --------------------------------------------------------------------------

def interpolate(df: DataFrame, cols: Sequence[str], order_col: str = "row_id",
                text_cols: Sequence[str] = (), text_fill: str = "NULL",
                rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Fill numeric ``cols`` by linear interpolation over the dense position in
    ``order_col`` order (equal spacing); leading nulls stay null, trailing
    nulls take the last value.  ``text_cols`` get ``text_fill``.

    Pass 1: range buckets of the (unique) order key; within each bucket a
    running last-non-null window forwards and backwards (frames always
    ``unboundedPreceding .. currentRow``).  A one-row-per-bucket summary gives
    offsets and the known values just before / after each bucket.
    Pass 2: join that summary (bounded by the bucket count) back.
    """
    spark = df.sparkSession
    bdf, _ = range_buckets(df, order_col, rows_per_bucket)
    wa = Window.partitionBy("_bucket").orderBy(F.col(order_col).asc())
    wd = Window.partitionBy("_bucket").orderBy(F.col(order_col).desc())
    run_a = wa.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_d = wd.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = bdf.withColumn("_lp", F.row_number().over(wa) - 1)
    for i, c in enumerate(cols):
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_lp").alias("p"), F.col(c).cast("double").alias("v")))
        x = (x.withColumn(f"_pv{i}", F.last(known, ignorenulls=True).over(run_a))
              .withColumn(f"_nx{i}", F.last(known, ignorenulls=True).over(run_d)))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        kp = F.when(F.col(c).isNotNull(), F.col("_lp"))
        aggs += [F.min_by(F.struct(F.col("_lp").alias("p"), F.col(c).cast("double").alias("v")), kp).alias(f"f{i}"),
                 F.max_by(F.struct(F.col("_lp").alias("p"), F.col(c).cast("double").alias("v")), kp).alias(f"l{i}")]
    summary = sorted(x.groupBy("_bucket").agg(*aggs).collect(), key=lambda r: r["_bucket"])
    # carry values between buckets: tiny driver loop over one row per bucket
    rows, off = [], 0
    offs = [0] * len(summary)
    for j, r in enumerate(summary):
        offs[j] = off
        off += r["n"]
    carry_in = [[None] * len(cols) for _ in summary]
    carry_out = [[None] * len(cols) for _ in summary]
    for i in range(len(cols)):
        last = None
        for j, r in enumerate(summary):
            carry_in[j][i] = last
            lk = r[f"l{i}"]
            if lk is not None and lk["v"] is not None:
                last = (offs[j] + lk["p"], lk["v"])
        nxt = None
        for j in range(len(summary) - 1, -1, -1):
            carry_out[j][i] = nxt
            fk = summary[j][f"f{i}"]
            if fk is not None and fk["v"] is not None:
                nxt = (offs[j] + fk["p"], fk["v"])
    for j, r in enumerate(summary):
        rec = [int(r["_bucket"]), offs[j]]
        for i in range(len(cols)):
            ci, co = carry_in[j][i], carry_out[j][i]
            rec += [ci[0] if ci else None, ci[1] if ci else None, co[0] if co else None, co[1] if co else None]
        rows.append(tuple(rec))
    fields = [T.StructField("_bucket", T.IntegerType()), T.StructField("_off", T.LongType())]
    for i in range(len(cols)):
        fields += [T.StructField(f"_cip{i}", T.LongType()), T.StructField(f"_civ{i}", T.DoubleType()),
                   T.StructField(f"_cop{i}", T.LongType()), T.StructField(f"_cov{i}", T.DoubleType())]
    carry = spark.createDataFrame(rows, T.StructType(fields))
    y = x.join(F.broadcast(carry), "_bucket").withColumn("_pos", F.col("_off") + F.col("_lp"))
    for i, c in enumerate(cols):
        pp = F.coalesce(F.col("_off") + F.col(f"_pv{i}.p"), F.col(f"_cip{i}"))
        pv = F.coalesce(F.col(f"_pv{i}.v"), F.col(f"_civ{i}"))
        np_ = F.coalesce(F.col("_off") + F.col(f"_nx{i}.p"), F.col(f"_cop{i}"))
        nv = F.coalesce(F.col(f"_nx{i}.v"), F.col(f"_cov{i}"))
        filled = (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                  .when(pv.isNull(), F.lit(None).cast("double"))
                  .when(nv.isNull(), pv)
                  .otherwise(pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp)))
        y = y.withColumn(c, filled)
    for c in text_cols:
        y = y.withColumn(c, F.coalesce(F.col(c), F.lit(text_fill)))
    drop = ["_bucket", "_lp", "_off", "_pos"] + [f"_{k}{i}" for i in range(len(cols))
                                                  for k in ("pv", "nx", "cip", "civ", "cop", "cov")]
    return y.drop(*drop)


def interpolate_by_group(df: DataFrame, cols: Sequence[str], group: str, order_col: str = "row_id",
                         rows_per_bucket: int = 2_000_000) -> DataFrame:
    """NUL-3, keyed form: linear interpolation within each group in
    ``order_col`` order (equal spacing, leading nulls stay, trailing nulls
    take the last value), safe for a group holding most of the rows.

    Rows are cut into global range buckets of the order key and ordered per
    (bucket, group), so a hot group is spread over many buckets.  A summary
    with one row per (bucket, group) carries each group's offsets and the
    known values just before / after a bucket; those carries are windows over
    the summary partitioned by group (at most one row per bucket each), with
    look-ahead done on the reversed order, never a following-unbounded frame.
    """
    bdf, _ = range_buckets(df, order_col, rows_per_bucket)
    part = ["_bucket", group]
    wa = Window.partitionBy(*part).orderBy(F.col(order_col).asc())
    wd = Window.partitionBy(*part).orderBy(F.col(order_col).desc())
    run_a = wa.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_d = wd.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = bdf.withColumn("_lp", F.row_number().over(wa) - 1)
    for i, c in enumerate(cols):
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_lp").alias("p"), F.col(c).cast("double").alias("v")))
        x = x.withColumn(f"_pv{i}", F.last(known, ignorenulls=True).over(run_a)) \
             .withColumn(f"_nx{i}", F.last(known, ignorenulls=True).over(run_d))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        kp = F.when(F.col(c).isNotNull(), F.col("_lp"))
        st = F.struct(F.col("_lp").alias("p"), F.col(c).cast("double").alias("v"))
        aggs += [F.min_by(st, kp).alias(f"_f{i}"), F.max_by(st, kp).alias(f"_l{i}")]
    summ = x.groupBy(*part).agg(*aggs)
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(group).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sel = [*part, "_off"]
    for i in range(len(cols)):
        gl = F.when(F.col(f"_l{i}").isNotNull(), F.struct((F.col("_off") + F.col(f"_l{i}.p")).alias("p"), F.col(f"_l{i}.v").alias("v")))
        gf = F.when(F.col(f"_f{i}").isNotNull(), F.struct((F.col("_off") + F.col(f"_f{i}.p")).alias("p"), F.col(f"_f{i}.v").alias("v")))
        summ = summ.withColumn(f"_gl{i}", gl).withColumn(f"_gf{i}", gf)
        summ = summ.withColumn(f"_ci{i}", F.last(f"_gl{i}", ignorenulls=True).over(before)) \
                   .withColumn(f"_co{i}", F.last(f"_gf{i}", ignorenulls=True).over(after))
        sel += [f"_ci{i}", f"_co{i}"]
    carry = cut_lineage(summ.select(*sel), "interp_carry")
    y = x.join(carry, part, "left").withColumn("_pos", F.col("_off") + F.col("_lp"))
    for i, c in enumerate(cols):
        pp = F.coalesce(F.col("_off") + F.col(f"_pv{i}.p"), F.col(f"_ci{i}.p"))
        pv = F.coalesce(F.col(f"_pv{i}.v"), F.col(f"_ci{i}.v"))
        np_ = F.coalesce(F.col("_off") + F.col(f"_nx{i}.p"), F.col(f"_co{i}.p"))
        nv = F.coalesce(F.col(f"_nx{i}.v"), F.col(f"_co{i}.v"))
        y = y.withColumn(c, F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                         .when(pv.isNull(), F.lit(None).cast("double"))
                         .when(nv.isNull(), pv)
                         .otherwise(pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp)))
    return y.select(*df.columns)


# --------------------------------------------------------------------------
# NUL-4: hierarchical group fill, computed on aggregates.
# --------------------------------------------------------------------------

def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def hierarchical_fill(df: DataFrame, numeric_cols: Sequence[str], text_cols: Sequence[str],
                      group_cols: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """Fill nulls from group statistics at prefix levels ``group_cols[:k]``,
    k = len .. 1, later (coarser) levels seeing earlier fills; what is left
    takes the global mean (numeric) or mode (text, ties to the smallest
    value), else ``unknown``.  Null group keys never match, as in pandas.

    The fact table is read twice in all: one aggregation by the finest key
    tuple gives, per finest group, the sum / count / null count of every
    numeric column and the null count of every text column; one
    (finest group, value) count per text column gives the value counts.
    Every level is then resolved on that small state (a finest group's null
    rows always share one fill value): level means come from the state's
    running sums, level modes from the base counts plus the counts already
    filled in.  Each level writes the state once (lineage cut); one join
    brings the fill values back to the rows.
    """
    numeric_cols, text_cols = list(numeric_cols), list(text_cols)
    keys = _present(df, group_cols)
    levels = [lv for lv in (_present(df, group_cols[:k]) for k in range(len(group_cols), 0, -1)) if lv]
    if not keys:
        out = df
        for c in numeric_cols:
            g = df.agg(F.avg(c)).first()[0]
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(g).cast("double")))
        for c in text_cols:
            m = global_mode(df, c).first()["mode"]
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(m if m is not None else unknown)))
        return out
    aggs = []
    for i, c in enumerate(numeric_cols):
        aggs += [F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(f"_s{i}"),
                 F.count(F.col(c)).alias(f"_k{i}"), F.count_if(F.col(c).isNull()).alias(f"_m{i}")]
    for j, c in enumerate(text_cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_tm{j}"))
    st = df.groupBy(*keys).agg(*aggs)
    for i in range(len(numeric_cols)):
        st = st.withColumn(f"_f{i}", F.lit(None).cast("double"))
    for j in range(len(text_cols)):
        st = st.withColumn(f"_tf{j}", F.lit(None).cast("string")).withColumn(f"_tn{j}", F.lit(0).cast("long"))
    st = cut_lineage(st, "hfill_state")
    base = [cut_lineage(df.where(F.col(c).isNotNull()).groupBy(*keys, F.col(c).alias("_v"))
                        .agg(F.count(F.lit(1)).alias("_n")), "hfill_counts") for c in text_cols]

    def counts(j):
        filled = st.where(F.col(f"_tf{j}").isNotNull()).select(*keys, F.col(f"_tf{j}").alias("_v"),
                                                              F.col(f"_tn{j}").alias("_n"))
        return base[j].unionByName(filled)

    for lv in levels:
        nxt = st
        if numeric_cols:
            means = st.where(_ok(lv)).groupBy(*lv).agg(
                *[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_k{i}")).alias(f"_mean{i}") for i in range(len(numeric_cols))])
            nxt = nxt.join(means, on=lv, how="left")
        for j in range(len(text_cols)):
            per = counts(j).where(_ok(lv)).groupBy(*lv, "_v").agg(F.sum("_n").alias("_n"))
            mode = per.groupBy(*lv).agg(
                F.min_by("_v", F.struct((-F.col("_n")).alias("a"), F.col("_v").alias("b"))).alias(f"_mode{j}"))
            nxt = nxt.join(mode, on=lv, how="left")
        # one projection per level (a long withColumn chain costs analysis time)
        upd = {}
        for i in range(len(numeric_cols)):
            hit = (F.col(f"_m{i}") > 0) & F.col(f"_mean{i}").isNotNull()
            upd[f"_f{i}"] = F.when(hit, F.col(f"_mean{i}")).otherwise(F.col(f"_f{i}"))
            upd[f"_s{i}"] = F.when(hit, F.col(f"_s{i}") + F.col(f"_m{i}") * F.col(f"_mean{i}")).otherwise(F.col(f"_s{i}"))
            upd[f"_k{i}"] = F.when(hit, F.col(f"_k{i}") + F.col(f"_m{i}")).otherwise(F.col(f"_k{i}"))
            upd[f"_m{i}"] = F.when(hit, F.lit(0)).otherwise(F.col(f"_m{i}")).cast("long")
        for j in range(len(text_cols)):
            hit = (F.col(f"_tm{j}") > 0) & F.col(f"_mode{j}").isNotNull()
            upd[f"_tf{j}"] = F.when(hit, F.col(f"_mode{j}")).otherwise(F.col(f"_tf{j}"))
            upd[f"_tn{j}"] = F.when(hit, F.col(f"_tm{j}")).otherwise(F.col(f"_tn{j}")).cast("long")
            upd[f"_tm{j}"] = F.when(hit, F.lit(0)).otherwise(F.col(f"_tm{j}")).cast("long")
        nxt = nxt.select(*[upd[c].alias(c) if c in upd else F.col(c) for c in st.columns])
        st = cut_lineage(nxt, "hfill_state")
    # global fallback: fitted scalars after every level's fills
    glob = {}
    if numeric_cols:
        row = st.agg(*[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_k{i}")).alias(f"g{i}")
                       for i in range(len(numeric_cols))]).first()
        glob.update({c: row[f"g{i}"] for i, c in enumerate(numeric_cols)})
    for j, c in enumerate(text_cols):
        tot = counts(j).groupBy("_v").agg(F.sum("_n").alias("_n"))
        glob[c] = tot.agg(F.min_by("_v", F.struct((-F.col("_n")).alias("a"), F.col("_v").alias("b")))).first()[0]
    fills = [*[(c, f"_f{i}") for i, c in enumerate(numeric_cols)], *[(c, f"_tf{j}") for j, c in enumerate(text_cols)]]
    any_fill = F.lit(False)
    for _, f in fills:
        any_fill = any_fill | F.col(f).isNotNull()
    fill = st.where(any_fill).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                                     *[F.col(f).alias(f"_fill_{c}") for c, f in fills])
    # null-safe key match: a finest group with a null key is still one group
    cond = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    filled = set(numeric_cols) | set(text_cols)
    out = df.join(fill, cond, "left").select(
        *[F.coalesce(F.col(c), F.col(f"_fill_{c}")).alias(c) if c in filled else F.col(c) for c in df.columns])
    for c in numeric_cols:
        if glob.get(c) is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(float(glob[c]))))
    for c in text_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(glob[c] if glob.get(c) is not None else unknown)))
    return out


def _ok(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def group_mode(df: DataFrame, keys: Sequence[str], c: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, ties to the smallest value.

    Two partial-aggregating steps (count per value, then pick), so a hot group
    never has to sit in one buffer row by row.
    """
    cnt = df.where(F.col(c).isNotNull()).groupBy(*keys, F.col(c).alias("_v")).count()
    return cnt.groupBy(*keys).agg(
        F.min_by("_v", F.struct((-F.col("count")).alias("a"), F.col("_v").alias("b"))).alias(name))


def global_mode(df: DataFrame, c: str) -> DataFrame:
    """One-row frame with column ``mode`` (null when the column is all null)."""
    cnt = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).count()
    return cnt.agg(F.min_by("_v", F.struct((-F.col("count")).alias("a"), F.col("_v").alias("b"))).alias("mode"))


# --------------------------------------------------------------------------
# NUL-5 .. NUL-8
# --------------------------------------------------------------------------

def fill_by_strategy(df: DataFrame, cols: Sequence[str], strategy: str = "mean",
                     exclude: Sequence[str] = ()) -> DataFrame:
    """NUL-5: mean / median / most_frequent fill, 'drop' rows, or 'none'."""
    cols = [c for c in cols if c not in set(exclude)]
    if strategy == "none" or not cols:
        return df
    if strategy == "drop":
        return df.dropna(subset=cols)
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        vals = {c: row[c] for c in cols}
    elif strategy == "median":
        q = quantiles(df, cols, [0.5])
        vals = {c: q[(c, 0.5)] for c in cols}
    elif strategy == "most_frequent":
        vals = {}
        for c in cols:
            vals[c] = global_mode(df, c).first()["mode"]
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = df
    for c in cols:
        if vals[c] is None:
            continue
        if strategy in ("mean", "median") and isinstance(df.schema[c].dataType, T.NumericType):
            # a numeric column with nulls is a float column in the reference
            out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(float(vals[c]))))
        else:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(vals[c]).cast(df.schema[c].dataType)))
    return out


def spread_group_stats(df: DataFrame, keys: Sequence[str], mean_cols: Sequence[str] = (),
                       mode_cols: Sequence[str] = (), count: bool = False) -> DataFrame:
    """WIN-1 / WIN-3: group mean, mode and size attached to every row.

    ``groupBy`` + join instead of a window over the group, so a hot group is
    pre-aggregated in parallel rather than buffered in one task."""
    stats = df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}_mean") for c in mean_cols],
                                  *([F.count(F.lit(1)).alias("group_size")] if count else []))
    out = df.join(stats, list(keys), "left")
    for c in mode_cols:
        out = out.join(group_mode(df, keys, c, f"{c}_mode"), list(keys), "left")
    return out


def fill_unknown(df: DataFrame, cols: Sequence[str], value: str = "Unknown") -> DataFrame:
    """NUL-6: text nulls to a fixed label before encoding."""
    return df.na.fill(value, subset=list(cols))


def inf_to_null_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NUL-7 first half: +-inf and NaN become null."""
    out = df
    for c in cols:
        out = out.withColumn(c, inf_to_null(c))
    return out


def typed_fill(df: DataFrame, group_cols: Sequence[str], exclude: Sequence[str] = ("row_id", "target", "is_test"),
               unknown: str = "Unknown") -> DataFrame:
    """NUL-8: detect numeric / text columns, fill hierarchically by group
    columns present (text by mode, numbers by mean)."""
    skip = set(exclude) | set(group_cols)
    num, txt = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            txt.append(f.name)
    return hierarchical_fill(df, num, txt, _present(df, group_cols), unknown=unknown)
