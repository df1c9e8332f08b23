"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; a temporary folder only where it is unset on one machine, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{root.rstrip('/')}/graph-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: plans after it begin there, and lost executors cost nothing before it."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
