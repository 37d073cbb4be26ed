"""Materialisation (MAT-1, MAT-2) and lineage cuts.

Lineage is cut with a reliable ``checkpoint`` (or a written table) in the
shared folder named by ``spark.checkpoint.dir``; a lost executor then costs a
re-read, not a recomputation of the whole chain.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root, scratch_path


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder.

    One write job, then a read of the written files: unlike an eager
    ``checkpoint`` (a count job plus a second job that recomputes the plan to
    write it) the plan runs once.  A lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def cache_key(name: str, **params) -> str:
    """Stable key from a name and the parameters that produced the table."""
    blob = json.dumps(params, sort_keys=True, default=str).encode()
    return f"{name}-{hashlib.sha1(blob).hexdigest()[:16]}"


def file_versions(df: DataFrame) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files that ``df`` reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return out


def materialize(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                root: str | None = None, inputs: tuple[DataFrame, ...] = (), **params) -> DataFrame:
    """MAT-1: read the table if a complete copy exists, else build, write, read.

    The key has ``params`` (options) and the files of ``inputs`` with their
    lengths and times, so rewritten input does not return a stale table.
    Completion is marked by ``_SUCCESS``.
    """
    root = root or os.path.join(checkpoint_root(spark), "materialized")
    path = os.path.join(root, cache_key(name, _files=[file_versions(d) for d in inputs], **params))
    if not _exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
