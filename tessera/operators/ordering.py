"""Global order without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` moves the whole table into
one task.  ``range_buckets`` instead lets Spark deal the rows by key range
(nulls first, in the key's own type) and writes them with their bucket, so
every later read, also after the loss of an executor, sees the same buckets.
Each bucket is ordered on its own; a small per-bucket table (one row per
bucket) carries offsets and boundary values between buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import cut_lineage


def range_buckets(df: DataFrame, key: str, rows_per_bucket: int = 2_000_000,
                  bucket_col: str = "_bucket") -> tuple[DataFrame, int]:
    """(``df`` with a bucket id that is monotone in ``key``, number of buckets).

    Null keys are first; equal keys share a bucket.  The number of buckets
    follows the number of rows and is the session's shuffle partitions at least."""
    spark = df.sparkSession
    n = df.select(key).count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), math.ceil(n / max(rows_per_bucket, 1)))
    dealt = df.repartitionByRange(buckets, F.col(key).asc_nulls_first())
    return cut_lineage(dealt.withColumn(bucket_col, F.spark_partition_id()), "range_buckets"), buckets


def with_position(df: DataFrame, key: str, pos_col: str = "pos", rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Dense 0-based position of each row in ascending ``key`` order, null keys
    first (key unique; rows of equal keys get adjacent positions in any order)."""
    bdf, _ = range_buckets(df, key, rows_per_bucket)
    # the prefix sum runs over one row per bucket
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bdf.groupBy("_bucket").count().select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy("_bucket").orderBy(F.col(key).asc_nulls_first())
    return (bdf.withColumn("_lp", F.row_number().over(own))
            .join(F.broadcast(offsets), "_bucket")  # one row per bucket
            .withColumn(pos_col, F.col("_off") + F.col("_lp") - 1)
            .drop("_bucket", "_lp", "_off"))
