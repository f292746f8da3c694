"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the cluster's shared folder.

    ``spark.checkpoint.dir`` names that folder. Where it is unset and the session runs in one process, a temporary
    folder is chosen; on a cluster, where executors would not share it, that is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete the files of a checkpoint that ``durable`` wrote; no frame that is still to be read may rest on it."""
    sc = df.sparkSession.sparkContext
    file = df._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that Spark hands to Python at a time, where the session has Spark's own default of 10,000: texts may be long.
BATCH_ROWS = "1000"


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded size; a task gives back the memory that it took, as workers are kept."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, BATCH_ROWS)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` turns one Arrow batch into another; rows keep their partition, nothing is shuffled."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return in_arrow(df, run, schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values behind each other, and the offset of each value (nulls are empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    if n == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans_of_rows(offsets: np.ndarray, most_bytes: int) -> list[tuple[int, int]]:
    """Cut rows into runs of at most ``most_bytes`` bytes; a longer row makes a run of its own."""
    out, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        out.append((lo, hi))
        lo = hi
    return out
