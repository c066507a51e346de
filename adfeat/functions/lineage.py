"""Intermediate results kept in the folder that driver and executors share, so that lost executors cost no recomputation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder for local masters that name none, an error on a cluster."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="adfeat-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, prefix: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows, checkpointed: nothing that reads them computes them again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
