"""Exactly-once append of newly arrived raw CSV files to a Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def ingest_raw_files(spark: SparkSession, source_dir: str, schema: T.StructType, table_dir: str,
                     checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                     partition_by: list[str] | None = None, available_now: bool = True,
                     max_files_per_trigger: int = 1000, multi_line: bool = False) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``transform`` is any stateless per-row function of the batch operators
    (e.g. ``standardize_customers``); ``checkpoint`` must be a shared folder.
    ``multi_line`` allows newlines inside quoted fields and makes every file one split.
    """
    stream = (spark.readStream.schema(schema)
              .option("header", True).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"')
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .csv(source_dir))
    if transform is not None:
        stream = transform(stream)
    w = (stream.writeStream.format("parquet").option("path", table_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
