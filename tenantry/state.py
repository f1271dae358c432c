"""Where intermediate tables live.

Iterative operators and multi-phase runs cut their lineage by writing a Parquet
table to the shared folder the cluster names in ``spark.checkpoint.dir``.  Such
a table survives the loss of any executor, and reading it back gives Catalyst
the true size, so that it picks the join strategy from facts.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of this session; only a local session gets one made for it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tenantry-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return a scan of what was written."""
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    return save(df, new_folder(df.sparkSession, label))
