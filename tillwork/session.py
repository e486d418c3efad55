"""Session settings the library relies on, and the folder it may write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can be applied to a session somebody else built.
# Joins in this library keep one side unique per key; a hot key then sits on the
# other side alone, which is the case adaptive skew splitting handles exactly.
# Forcing it keeps the split even when a later exchange has to be added.
_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tillwork", master: str | None = None, **conf: str) -> SparkSession:
    # call sites of every column operation cost more than planning does
    builder = SparkSession.builder.appName(app).config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint location the cluster names.

    On one machine without such a location a temporary one is set. Elsewhere that would be
    a different folder on every executor, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tillwork-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Stores an intermediate that is needed more than once, and reads it back.

    Used for results that are far smaller than what they were computed from. Unlike a cache
    it outlives executors, it cuts the lineage, and its size is known to the optimiser.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
