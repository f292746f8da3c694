"""Lineage cut with checkpoints in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where that is unset, a local session gets a temporary one; on a cluster it is an
    error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in that folder, for tables that are written and read again."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete a checkpoint's files; nothing that is still to be read may rest on it."""
    sc = df.sparkSession.sparkContext
    file = df._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
