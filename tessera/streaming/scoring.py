"""Scoring of arriving files (INF-1 on a stream).

The reference has no streaming; its scoring step (align columns, apply the
fitted encoders / scalers, predict, cast) is stateless per row, so the same
plan runs unchanged on a Structured Streaming source: new parquet files are
scored as they land, with the stream's progress kept under the shared
checkpoint folder (restart-safe, exactly-once to the file sink).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import checkpoint_root


def score_stream(spark: SparkSession, source_dir: str, schema: StructType,
                 transform: Callable[[DataFrame], DataFrame], sink_dir: str,
                 name: str = "scoring", available_now: bool = True):
    """Start a query reading parquet files from ``source_dir``, applying
    ``transform`` (built from fitted parameter tables / a model) and
    appending results to ``sink_dir``.  Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    out = transform(stream)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir)
              .option("checkpointLocation", os.path.join(checkpoint_root(spark), "streams", name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
