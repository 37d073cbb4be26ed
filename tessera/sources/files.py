"""File sources and sinks (SRC-1, SNK-1 .. SNK-4).

Paths are folders of part files (the cluster writes in parallel).  CSV is
read with an explicit schema: inference costs a full extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..session import scratch_path

# The dialect of pandas: quotes doubled inside quoted fields, newlines kept.
# Empty text is written quoted and null as nothing, so both come back.
_DIALECT = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "quote": '"', "escape": '"', "nullValue": "", "encoding": "UTF-8"}
CSV_WRITE = {**_DIALECT, "emptyValue": '""'}
_EMPTY = "\ue000"  # how a quoted empty field is read, so that it isn't taken for null
CSV_READ = {**_DIALECT, "emptyValue": _EMPTY, "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             encoding: str = "UTF-8", index_col: str | None = None, multi_line: bool = True) -> DataFrame:
    """SRC-1: header CSV with a given schema (``None`` infers: one more pass).

    A UTF-8 byte-order mark in the header is removed from the first name.
    ``index_col`` names a column to drop after reading (pandas index).  Files
    without newlines inside fields can be split among tasks: ``multi_line=False``."""
    r = spark.read.options(**CSV_READ).option("encoding", encoding).option("multiLine", multi_line)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", "true").csv(path)
    first = df.columns[0] if df.columns else None
    if first and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    if index_col and index_col in df.columns:
        df = df.drop(index_col)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.when(F.col(f"`{c}`") == _EMPTY, "").otherwise(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
                       for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """SNK-1: header CSV in UTF-8, without a byte-order mark."""
    df.write.mode(mode).options(**CSV_WRITE).csv(path)
    return path


def csv_roundtrip(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as CSV under the shared scratch folder and read it back
    with the same schema (nulls, empty strings and blanks preserved)."""
    path = scratch_path(df.sparkSession, name)
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def write_predictions(df: DataFrame, base: str, run_id: str, pred: str = "target",
                      key: str = "row_id") -> str:
    """SNK-2: predictions cast to integer (truncating, as ``astype(int)``),
    written under a run-id folder; an existing folder is an error, never a
    silent overwrite (replaces probing for free ``_1``/``_2`` names)."""
    path = f"{base.rstrip('/')}/run={run_id}"
    df.select(key, F.col(pred).cast("bigint").alias(pred)).write.mode("errorifexists").parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK-3: long rows, e.g. (method, set, feature), as JSON lines."""
    df.write.mode(mode).json(path)
    return path


def write_selection(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK-3: rows (method, set, feature) as one JSON object, from ``method_set`` to
    the sorted list of its features (its size follows the number of columns)."""
    lists = df.groupBy(F.concat_ws("_", "method", "set").alias("name")).agg(F.sort_array(F.collect_set("feature")).alias("features"))
    whole = lists.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "features")))).alias("m"))
    whole.select(F.to_json("m").alias("value")).coalesce(1).write.mode(mode).text(path)
    return path


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """(method, set, feature) of what ``write_selection`` wrote."""
    read = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("name", "features"))
    last = F.element_at(F.split("name", "_"), -1)
    return read.select(F.expr("left(name, length(name) - length(element_at(split(name, '_'), -1)) - 1)").alias("method"), last.alias("set"),
                       F.explode("features").alias("feature"))


def save_model(model, path: str) -> str:
    """SNK-4: persist a fitted ``pyspark.ml`` model / pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """SNK-4: load a pipeline model saved by ``save_model``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
