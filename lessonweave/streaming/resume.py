"""Resumable batches as a stream: files that were done are not done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_new_files(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Take the JSON files that have arrived since the last call, transform them and append the result as Parquet.

    The checkpoint folder remembers what was taken, and the file sink's log makes each batch count once, also
    after a failure in the middle.
    """
    rows = spark.readStream.schema(schema).json(source)
    stream = transform(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    stream.trigger(availableNow=True).start().awaitTermination()
