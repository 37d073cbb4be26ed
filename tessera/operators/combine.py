"""Sources combined, joins, set operations, sampling (SRC-2/3, JOI-*, SET-*, SMP-*, FIL-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_unit, haversine_km
from .ordering import with_position


def stack_train_test(train: DataFrame, test: DataFrame, flag: str = "is_test", target: str = "target",
                     test_target=0.0, renames: dict[str, str] | None = None) -> DataFrame:
    """SRC-2 / SET-1: tag, stack (bag union by name, missing columns null),
    test target set to ``test_target``, optional renames."""
    tr = train.withColumn(flag, F.lit(0).cast("int"))
    te = test.withColumn(flag, F.lit(1).cast("int"))
    out = tr.unionByName(te, allowMissingColumns=True)
    if target in out.columns and test_target is not None:
        out = out.withColumn(target, F.when(F.col(flag) == 1, F.lit(test_target)).otherwise(F.col(target)))
    for a, b in (renames or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def split_train_test(df: DataFrame, flag: str = "is_test", target: str = "target",
                     test_target: float | None = 0.0) -> tuple[DataFrame, DataFrame]:
    """FIL-1: split by flag and drop it; test target reset (or removed if None)."""
    tr = df.where(F.col(flag) == 0).drop(flag)
    te = df.where(F.col(flag) == 1).drop(flag)
    if target in te.columns:
        te = te.drop(target) if test_target is None else te.withColumn(target, F.lit(test_target))
    return tr, te


def concat_by_key(base: DataFrame, *others: DataFrame, key: str = "row_id", how: str = "inner") -> DataFrame:
    """JOI-4 / SRC-3: column concat by explicit key; a name already present
    on the left is dropped from the later table."""
    out = base
    for o in others:
        keep = [c for c in o.columns if c == key or c not in out.columns]
        out = out.join(o.select(*keep), key, how)
    return out


def lookup_fill(df: DataFrame, book: DataFrame, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """JOI-6: fill null coordinates by one lookup per distinct key.

    Only rows missing any of ``cols`` look up; a key is used only when every
    looked-up column is found.  Returns (filled table, one-row miss report)."""
    need = F.lit(False)
    for c in cols:
        need = need | F.col(c).isNull()
    keys = df.where(need).select(key).distinct()
    found = F.lit(True)
    for c in cols:
        found = found & F.col(c).isNotNull()
    book1 = book.where(found).groupBy(key).agg(*[F.min(c).alias(f"_bk_{c}") for c in cols])
    hits = keys.join(book1, key, "left")
    report = hits.agg(F.count(F.lit(1)).alias("keys"),
                      F.count_if(F.col(f"_bk_{cols[0]}").isNull()).alias("misses"))
    filled = df.join(hits, key, "left").select(
        *[F.when(need, F.coalesce(F.col(c), F.col(f"_bk_{c}"))).otherwise(F.col(c)).alias(c)
          if c in cols else F.col(c) for c in df.columns])
    # a row takes the book values only when every coordinate was found
    return filled, report


def landmark_distance(df: DataFrame, marks: DataFrame, key: str = "district", lat: str = "lat", lon: str = "lon",
                      mark_lat: str = "lead_lat", mark_lon: str = "lead_lon", out: str = "landmark_km") -> DataFrame:
    """JOI-1 + GEO-2: inner join to a per-district landmark and the haversine
    km; the join strategy follows the landmark table's size at run time."""
    return df.join(marks, key, "inner") \
             .withColumn(out, haversine_km(F.col(lat), F.col(lon), F.col(mark_lat), F.col(mark_lon)))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """SMP-2: deterministic fraction sample by hashed key (oracle-checkable)."""
    cut = int(round(fraction * 1000))
    return df.where(hash_unit(key, seed) % 1000 < cut)


def bootstrap(df: DataFrame, fraction: float = 0.02, seed: int = 42) -> DataFrame:
    """SMP-1: sample with replacement (Poisson per row; size approximate)."""
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def bootstrap_exact(df: DataFrame, n: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """SMP-1 exact-size variant: ``n`` independent draws of a dense row position,
    joined to the rows; exactly ``n`` rows for any ``n`` (none from no rows)."""
    rows = df.count()
    if rows == 0 or n <= 0:
        return df.limit(0)
    draws = df.sparkSession.range(n).select(F.least(F.floor(F.rand(seed) * rows), F.lit(rows - 1)).alias("_pos"))
    return with_position(df, key, "_pos").join(draws, "_pos").drop("_pos")


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-4: rows only in ``a`` / only in ``b`` (bag semantics), as counts.

    One plan: each distinct row gets its multiplicity on both sides (a full
    outer join of two grouped counts, null-safe on every column), then the
    surplus on each side is summed."""
    cols = a.columns
    ca = a.groupBy(*cols).agg(F.count(F.lit(1)).alias("_na"))
    cb = b.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_nb"))
    cb = cb.select(*[F.col(c).alias(f"_b_{c}") for c in cols], "_nb")
    j = ca.join(cb, [ca[c].eqNullSafe(cb[f"_b_{c}"]) for c in cols], "full")
    na, nb = F.coalesce(F.col("_na"), F.lit(0)), F.coalesce(F.col("_nb"), F.lit(0))
    return j.agg(F.sum(F.greatest(na - nb, F.lit(0))).cast("bigint").alias("only_left"),
                 F.sum(F.greatest(nb - na, F.lit(0))).cast("bigint").alias("only_right"))


def drop_duplicates_report(df: DataFrame, subset=None) -> tuple[DataFrame, DataFrame]:
    """FIL-4: duplicate rows dropped, plus a one-row report of rows removed
    (from one grouped count: rows = sum of counts, kept = number of groups)."""
    keys = list(subset or df.columns)
    out = df.dropDuplicates(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rep = g.agg(F.sum("_n").cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")) \
           .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
    return out, rep
