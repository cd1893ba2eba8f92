"""Traffic per region and time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.constants import BUCKET_MINUTES
from skytally.functions.times import bucket_start


def aggregate_traffic(states: DataFrame, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Exact distinct aircraft per (region, bucket).

    A bucket exists only if a poll produced data for it: gaps are never filled, because a missed
    poll is not the same as an empty sky. Spark first collapses repeated sightings inside each
    input split and shuffles on (region, bucket, aircraft), so a crowded bucket is spread out.
    """
    sightings = states.select(
        F.col("nearest_region").alias("region"),
        bucket_start(F.col("poll_timestamp"), bucket_minutes).alias("bucket_sk"),
        "icao24",
    ).filter(F.col("region").isNotNull() & F.col("bucket_sk").isNotNull())
    return sightings.groupBy("region", "bucket_sk").agg(F.count_distinct("icao24").alias("aircraft_count"))
