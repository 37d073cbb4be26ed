"""Sources, sinks and materialisation."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.sources import files
from tessera.sources.store import cut_lineage, materialize


def test_materialize_builds_once_per_key(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(0, 10).withColumn("sq", F.col("id") * F.col("id"))

    root = tempfile.mkdtemp(prefix="tessera-mat-", dir="/tmp")
    a = materialize(spark, "squares", build, root=root, source="x")
    b = materialize(spark, "squares", build, root=root, source="x")
    c = materialize(spark, "squares", build, root=root, source="y")   # other parameters -> other table
    assert len(calls) == 2
    assert sorted(r.sq for r in a.collect()) == sorted(r.sq for r in b.collect()) == sorted(r.sq for r in c.collect())


def test_read_csv_strips_bom_and_index(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    with open(os.path.join(d, "part-0.csv"), "w", encoding="utf-8") as fh:
        fh.write("﻿idx,name,val\n0,a,1.5\n1,,2.0\n")
    df = files.read_csv(spark, d, "idx int, name string, val double", index_col="idx")
    assert df.columns == ["name", "val"]
    rows = sorted(df.collect(), key=lambda r: r.val)
    assert (rows[0].name, rows[1].name) == ("a", None)


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(0, 1000).withColumn("g", F.col("id") % 7)
    cut = cut_lineage(df.groupBy("g").count())
    assert sorted(r["count"] for r in cut.collect()) == sorted(r["count"] for r in df.groupBy("g").count().collect())


def test_csv_round_trip_keeps_quotes_newlines_empty_and_null(spark):
    texts = ["", None, 'say "x", y', "a\nb", '\\"', " pad ", '""', ",", '"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert [r.t for r in files.csv_roundtrip(df, "quotes").orderBy("id").collect()] == texts


def test_pandas_written_csv_is_read_as_written(spark):
    import pandas as pd
    d = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    pdf = pd.DataFrame({"id": range(4), "t": ['a "b"', 'c, "d"', "e\nf", "g"]})
    pdf.to_csv(os.path.join(d, "x.csv"), index=False)
    assert [r.t for r in files.read_csv(spark, d, "id int, t string").orderBy("id").collect()] == list(pdf.t)


def test_rewritten_input_is_built_anew(spark):
    root, src = tempfile.mkdtemp(prefix="tessera-mat-", dir="/tmp"), tempfile.mkdtemp(prefix="tessera-src-", dir="/tmp")
    for rows in (5, 9):
        spark.range(rows).write.mode("overwrite").parquet(src)
        df = spark.read.parquet(src)
        assert materialize(spark, "copy", lambda df=df: df, root=root, inputs=(df,)).count() == rows
