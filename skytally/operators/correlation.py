"""Anomalies next to conflict events of the same region and time."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.constants import BUCKET_MINUTES


def correlate_with_events(
    scored: DataFrame,
    events: DataFrame,
    window_minutes: int = 60,
    bucket_minutes: int = BUCKET_MINUTES,
    directions: tuple[str, ...] = ("drop",),
) -> DataFrame:
    """For each anomalous bucket: events of its region within ``window_minutes`` either side.

    Both window ends are inclusive. Events are first folded into time cells whose edges every
    window edge falls on, so the range condition becomes an equi-join on (region, cell) and no
    (anomaly, event) pair is ever formed; a burst of events in one region and moment collapses
    before the shuffle. Events exactly on a cell edge are kept apart, for the inclusive end.
    """
    step = math.gcd(window_minutes, bucket_minutes) * 60
    micros = F.unix_micros("event_timestamp")
    cells = (
        events.filter(F.col("event_timestamp").isNotNull())
        .select(
            F.col("nearest_region").alias("region"),
            F.floor(micros / F.lit(step * 1_000_000)).alias("cell"),
            (F.pmod(micros, F.lit(step * 1_000_000)) == 0).alias("on_edge"),
            F.coalesce("num_mentions", F.lit(1.0)).alias("mentions"),
            "goldstein_scale",
            "global_event_id",
        )
        .groupBy("region", "cell", "on_edge")
        .agg(
            F.count("*").alias("n"),
            F.sum("mentions").alias("mentions"),
            F.min("goldstein_scale").alias("goldstein"),
            F.max(F.struct("mentions", "global_event_id")).alias("top"),
        )
    )
    moment = F.unix_seconds("bucket_sk")
    first = F.floor((moment - window_minutes * 60) / step)
    last = F.floor((moment + window_minutes * 60) / step)
    keys = ["region", "bucket_sk", "aircraft_count", "z_score", "anomaly_status"]
    anomalies = scored.filter(F.col("anomaly_direction").isin(list(directions))).select(
        *keys, last.alias("last"), F.explode(F.sequence(first, last)).alias("cell")
    )
    matched = anomalies.alias("a").join(
        cells.alias("c"),
        (F.col("a.region") == F.col("c.region"))
        & (F.col("a.cell") == F.col("c.cell"))
        & ((F.col("a.cell") < F.col("a.last")) | F.col("c.on_edge")),
        "left",
    )
    return (
        matched.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys])
        .agg(
            F.coalesce(F.sum("c.n"), F.lit(0)).alias("event_count"),
            F.coalesce(F.sum("c.mentions"), F.lit(0.0)).alias("event_mentions"),
            F.min("c.goldstein").alias("min_goldstein"),
            F.max("c.top").alias("top"),
        )
        .withColumn("top_event_id", F.col("top.global_event_id"))
        .drop("top")
    )
