"""Tables that later steps read several times: checkpoints in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Only a local session without one (tests) gets a folder here; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{tempfile.mkdtemp(prefix='genespark-')}"


def kept(df: DataFrame) -> DataFrame:
    """The table as a checkpoint: computed once, its lineage cut, safe from lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the shared one."""
    return f"{folder(spark)}/genespark-{name}-{uuid.uuid4().hex}"
