"""Session construction and the shared scratch / checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8,
              driver_memory: str = "16g", app: str = "tessera",
              extra: dict | None = None) -> SparkSession:
    """Local session used by tests, bench and the command line.

    On a cluster the session is built by the platform; library code never
    calls this and only reads settings from the session it is given.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without the setting gets a private temp
    folder; on a cluster an unset value is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path for a written table under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return os.path.join(root, "tables", leaf)


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def with_library(spark: SparkSession) -> None:
    """Puts this library on the path of Python workers that were not started with it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
