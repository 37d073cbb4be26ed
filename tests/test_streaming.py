"""Stream scoring gives the same rows as the batch plan."""

import os
import tempfile

from pyspark.sql import functions as F

from places import SF001
from tessera.operators import encode
from tessera.sources import views
from tessera.streaming.scoring import score_stream


def test_stream_scoring_equals_batch(spark):
    t = views.trades(spark, SF001).select("row_id", "district", "target", "is_test")
    means, g = encode.target_means(t.where("is_test = 0"), "district", "target")
    tmp = tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp")
    src, sink = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    t.where("is_test = 1").drop("target").write.parquet(src)

    def transform(df):
        return encode.apply_target_means(df, "district", F.broadcast(means), g, out="pred").select("row_id", "pred")

    q = score_stream(spark, src, spark.read.parquet(src).schema, transform, sink, name=os.path.basename(tmp))
    q.awaitTermination(120)
    got = {r.row_id: r.pred for r in spark.read.parquet(sink).collect()}
    want = {r.row_id: r.pred for r in transform(spark.read.parquet(src)).collect()}
    assert got == want and len(got) > 0
