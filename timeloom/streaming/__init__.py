"""Incremental processing.

The source has no streaming operators; its "streaming" is an out-of-core
batch engine, which Spark's batch execution already covers (it spills).
What is kept here is the incremental form of ``sink_parquet``: new files in
an input folder are read as a stream, passed through a batch transform, and
appended to the output, with progress in a checkpoint under the shared
``spark.checkpoint.dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timeloom.session import checkpoint_dir

__all__ = ["sink_parquet_incremental"]


def sink_parquet_incremental(spark: SparkSession, source: str, schema, out: str, name: str,
                             transform: Callable[[DataFrame], DataFrame] | None = None,
                             partition_by=None) -> None:
    """Process every file not seen before in ``source`` and append the result
    to ``out``; returns when the files present at start are done
    (``availableNow``). Exactly-once through the streaming checkpoint."""
    stream = spark.readStream.schema(schema).parquet(source)
    if transform is not None:
        stream = transform(stream)
    w = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}")
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.start().awaitTermination()
