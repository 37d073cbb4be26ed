"""Written intermediate tables and bounded bitmaps of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, with_library


def row_and_text(docs: DataFrame, text_col: str, carry: list[str] | None) -> tuple[list[Column], str | None]:
    """Columns ``row`` (struct of the ``carry`` columns; all, if not given) and, only
    if the row does not hold it, ``text``; and the field of the row that is the text.  So
    a text goes to the Python workers once."""
    names = carry or docs.columns
    row = F.struct(*[docs[c] for c in names]).alias("row")
    if names.count(text_col) == 1 and dict(docs.dtypes).get(text_col) == "string":
        return [row], text_col
    return [row, F.col(text_col).cast("string").alias("text")], None


def text_of(batch: pa.RecordBatch, field: str | None) -> pa.Array:
    """The texts of a batch with the columns of ``row_and_text``."""
    return batch.column("text") if field is None else pc.struct_field(batch.column("row"), field)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder (cuts lineage; after
    the loss of an executor it is read again, not computed again)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this library on the Python workers' path, for
    sessions whose workers were not started with it (on a cluster the package
    is installed or shipped, and the extra path does no harm)."""
    with_library(df.sparkSession)
    return df.mapInArrow(fn, schema)


def pandas_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """The same for ``df.mapInPandas``."""
    with_library(df.sparkSession)
    return df.mapInPandas(fn, schema)


class IdFilter:
    """A bitmap of 2**bits hashed ids: a superset test of fixed size.  It has
    no misses; ids that only share a bit are removed by a later join."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @staticmethod
    def of(df: DataFrame, hashed: Column, bits: int = 24) -> "IdFilter":
        slot = F.shiftrightunsigned(hashed.cast("long"), 64 - bits)
        got = (df.select(slot.alias("s"))
               .groupBy(F.shiftright("s", 6).alias("w"))
               .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b"))
               .toPandas())  # at most 2**(bits - 6) rows, whatever the input
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).view(np.uint64)
        return IdFilter(words, bits)

    def test(self, hashed: np.ndarray) -> np.ndarray:
        slot = hashed.astype(np.uint64) >> np.uint64(64 - self.bits)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
