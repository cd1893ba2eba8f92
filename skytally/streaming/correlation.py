"""Anomalies and conflict events as two streams, matched within a window of time with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from skytally.schemas import PAIRS
from skytally.sources.tables import read_log, write_batch


def match_events(anomalies: DataFrame, events: DataFrame, window_minutes: int, lateness: str) -> DataFrame:
    """Pairs of an anomalous bucket and an event of its region within ``window_minutes`` either side, both ends included.

    Each side waits in the state until the other side's watermark has passed its window, so the state follows the lateness and not the
    history. What comes later than ``lateness`` finds no partner.
    """
    around = F.make_dt_interval(mins=F.lit(window_minutes))
    left = anomalies.select(F.col("region").alias("a_region"), "bucket_sk").withWatermark("bucket_sk", lateness)
    right = events.select(
        "nearest_region", "event_timestamp", "global_event_id", F.coalesce("num_mentions", F.lit(1.0)).alias("mentions"), "goldstein_scale"
    ).withWatermark("event_timestamp", lateness)
    near = F.col("event_timestamp").between(F.col("bucket_sk") - around, F.col("bucket_sk") + around)
    pairs = left.join(right, (F.col("a_region") == F.col("nearest_region")) & near)
    return pairs.select(F.col("a_region").alias("region"), "bucket_sk", "global_event_id", "mentions", "goldstein_scale")


def store_pairs(pairs: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return pairs.writeStream.outputMode("append").foreachBatch(on_batch).option("checkpointLocation", checkpoint)


def correlated(spark: SparkSession, anomalies: DataFrame, path: str) -> DataFrame:
    """What ``correlate_with_events`` gives, from the stored pairs: per anomaly the number of its events, their mentions, the least
    Goldstein value and the most mentioned event. A pair stored again, after a bucket was scored anew, counts once."""
    keys = ["region", "bucket_sk", "aircraft_count", "z_score", "anomaly_status"]
    pairs = read_log(spark, path, PAIRS).drop("batch_id").distinct()
    matched = anomalies.select(*keys).join(pairs, ["region", "bucket_sk"], "left")
    top = F.max_by("global_event_id", F.struct("mentions", "global_event_id")).alias("top_event_id")
    return matched.groupBy(*keys).agg(
        F.count("global_event_id").alias("event_count"),
        F.coalesce(F.sum("mentions"), F.lit(0.0)).alias("event_mentions"),
        F.min("goldstein_scale").alias("min_goldstein"),
        top,
    )
