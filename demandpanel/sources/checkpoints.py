"""Reliable checkpoints in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable without ever choosing a folder on a cluster.

    The session's ``spark.checkpoint.dir`` wins. Only a local session without one gets
    a temporary folder; a cluster session without one is an error.
    """
    if "connect" in type(spark).__module__:
        return  # The server owns the folder.
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="demandpanel-checkpoint-")
    context.setCheckpointDir(folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the folder of checkpoints, read back: like ``checkpoint()``, but in
    columns and compressed."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
