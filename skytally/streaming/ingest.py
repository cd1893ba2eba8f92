"""Streams from landing files to bronze and silver.

Every stream runs with ``availableNow``: it drains what has arrived, then stops. The checkpoint
remembers what was read and the file sink commits whole batches, so a second run without new
files writes nothing and a failed run leaves no half batch behind.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.listener import StreamingQueryProgress

from skytally.functions.times import partition_date
from skytally.operators.cleaning import clean_events, clean_states
from skytally.schemas import EVENTS, STATES, with_columns
from skytally.sources.polls import flatten_states
from skytally.sources.tables import read_log, write_batch

SILVER_STATES = with_columns(STATES, "dt DATE")
SILVER_EVENTS = with_columns(EVENTS, "source_file STRING")


class Drained(NamedTuple):
    rows: int
    observed: Counter  # sums of what the stream observes, by name


def drain_observed(writer: DataStreamWriter) -> Drained:
    """Run a stream until nothing new is left; the rows it read, and what it observed.

    A query remembers its last micro-batches only, so they are looked at while it runs.
    """
    query = writer.trigger(availableNow=True).start()
    seen: dict[int, StreamingQueryProgress] = {}
    running = True
    while running:
        running = not query.awaitTermination(1)
        seen.update((p.batchId, p) for p in query.recentProgress if p.numInputRows or p.batchId not in seen)
    observed: Counter = Counter()
    for progress in seen.values():
        for metrics in (progress.observedMetrics or {}).values():
            observed.update({k: v or 0 for k, v in metrics.asDict().items()})
    return Drained(sum(p.numInputRows for p in seen.values()), observed)


def drain(writer: DataStreamWriter) -> int:
    """Run a stream until nothing new is left; the number of rows it read."""
    return drain_observed(writer).rows


def _dated_sink(df: DataFrame, kind: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Rows are dealt by day first: else each task of a micro-batch writes a file for each day it has seen."""
    return (
        df.hint("rebalance", "dt")
        .writeStream.format(kind)
        .outputMode("append")
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def polls_to_bronze(polls: DataFrame, bronze: str, checkpoint: str) -> DataStreamWriter:
    dated = flatten_states(polls).withColumn("dt", partition_date(F.col("poll_timestamp")))
    return _dated_sink(dated, "json", bronze, checkpoint)


def records_to_silver(records: DataFrame, silver: str, checkpoint: str) -> DataStreamWriter:
    dated = clean_states(records).withColumn("dt", partition_date(F.col("poll_timestamp")))
    return _dated_sink(dated, "parquet", silver, checkpoint)


def exports_to_silver(exports: DataFrame, silver: str, checkpoint: str) -> DataStreamWriter:
    """Events keep the name of their export: a later export may repeat an event, and replaces it."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(clean_events(batch, keep=("source_file",)), silver, batch_id)

    return exports.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)


def read_silver_states(spark: SparkSession, path: str) -> DataFrame:
    """Committed rows only: the reader follows the stream sink's own commit log."""
    return spark.read.schema(SILVER_STATES).parquet(path)


def read_silver_events(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, SILVER_EVENTS)


def stream_silver_states(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SILVER_STATES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
