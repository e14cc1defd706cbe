"""Ten-minute null counts on a stream (the D1 count, incremental).

Counts add up, so no state is kept between micro-batches and no row is ever too
late: each micro-batch is counted by the batch operator and appended to a
Parquet log under its epoch, and the count of a bucket is the sum over the
epochs. The log is idempotent per epoch (a replayed epoch overwrites its own
folder), which makes the sink exactly-once across executor or driver restarts.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import null_count
from ..session import scratch_path


def append_counts(stream: DataFrame, ts: str, columns, log_path: str, checkpoint: str, keys: Iterable[str] = (),
                  trigger: dict | None = None):
    """Start the query: the counts of every micro-batch go to ``log_path/epoch=N``."""
    def write(batch: DataFrame, epoch: int) -> None:
        null_count(batch, ts, columns, keys).write.mode("overwrite").parquet(f"{log_path}/epoch={epoch}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def current_counts(spark: SparkSession, log_path: str, keys: Iterable[str] = (), column_name: str = "column") -> DataFrame:
    """The counts of all epochs so far, added up per series and bucket."""
    return spark.read.parquet(log_path).groupBy(*keys, column_name, "bucket_dt").agg(
        F.sum("null_count").alias("null_count"), F.sum("total_count").alias("total_count"))


def run_available(spark: SparkSession, path: str, columns, out: str | None = None, keys: Iterable[str] = (),
                  ts: str = "ts") -> DataFrame:
    """Process all files now under ``path`` (``availableNow``) and return the counts."""
    out = out or scratch_path(spark, "null_count_stream")
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
    local = path[len("file:"):] if path.startswith("file:") else path
    if os.path.isfile(local):     # a stream source watches a folder: filter it to this file
        reader = reader.option("pathGlobFilter", os.path.basename(local))
        path = os.path.dirname(path)
    append_counts(reader.parquet(path), ts, columns, f"{out}/log", f"{out}/checkpoint", keys).awaitTermination()
    return current_counts(spark, f"{out}/log", keys)
