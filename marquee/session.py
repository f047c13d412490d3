"""Session settings the engine is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skew handling matters here: one key may hold a large part of all rows, and the plans keep
# hot keys on the side of a join that adaptive execution is able to split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "marquee", **extra: str) -> SparkSession:
    """A session with the engine's settings; `extra` uses `__` for the dots in a key.

    On a cluster leave `master` and the sizing keys to the submit command.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor reaches: the one the cluster names in `spark.checkpoint.dir`.

    Only a local session without the setting, as in tests, gets a temporary folder.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="marquee-")


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame stored as Parquet in the shared folder, which survives the loss of executors. The
    files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marquee-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
