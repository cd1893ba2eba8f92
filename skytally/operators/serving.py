"""Projections to and from key-value items of the serving store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.constants import ALERT_STATUSES, NO_BASELINE
from skytally.functions.numbers import to_exact_decimal
from skytally.functions.times import iso_offset, iso_utc

REGION_PREFIX, BUCKET_PREFIX, STATUS_PREFIX, EVENT_PREFIX = "REGION#", "BUCKET#", "STATUS#", "EVENT#"


def serving_traffic(traffic: DataFrame) -> DataFrame:
    """Traffic items: prefixed keys, exact decimals, and an alert key on alerts only."""
    status = F.col("anomaly_status")
    numbers = ["aircraft_count", "rolling_mean", "rolling_std", "z_score", "baseline_n"]
    return traffic.select(
        F.concat(F.lit(REGION_PREFIX), "region").alias("region_pk"),
        F.concat(F.lit(BUCKET_PREFIX), iso_offset(F.col("bucket_sk"))).alias("bucket_sk"),
        *[to_exact_decimal(F.col(n)).alias(n) for n in numbers],
        "anomaly_status",
        "anomaly_direction",
        F.when(status.isin(ALERT_STATUSES), F.concat(F.lit(STATUS_PREFIX), status)).alias("status_gsi_pk"),
    )


def serving_events(events: DataFrame) -> DataFrame:
    """Event items; an empty actor is a missing one."""
    numbers = [
        "action_geo_lat",
        "action_geo_long",
        "quad_class",
        "goldstein_scale",
        "num_mentions",
        "num_sources",
        "num_articles",
    ]
    return events.select(
        F.concat(F.lit(EVENT_PREFIX), "global_event_id").alias("event_pk"),
        F.concat(F.lit(REGION_PREFIX), "nearest_region").alias("region_gsi_pk"),
        iso_utc(F.col("event_timestamp")).alias("event_timestamp"),
        *[to_exact_decimal(F.col(n)).alias(n) for n in numbers],
        F.nullif("actor1_name", F.lit("")).alias("actor1_name"),
        F.nullif("actor2_name", F.lit("")).alias("actor2_name"),
        "event_code",
        "source_url",
    )


def as_json(items: DataFrame) -> DataFrame:
    """One JSON object per item; missing attributes are left out."""
    body = F.to_json(F.struct(*items.columns), {"ignoreNullFields": "true"})
    return items.select(body.alias("item"))


def decode_traffic(items: DataFrame) -> DataFrame:
    """Traffic items back to rows; a missing status means the default, a missing mean stays NULL."""
    bucket = F.regexp_replace("bucket_sk", f"^{BUCKET_PREFIX}", "")
    return items.select(
        F.regexp_replace("region_pk", f"^{REGION_PREFIX}", "").alias("region"),
        F.to_timestamp(bucket).alias("bucket_sk"),
        F.col("aircraft_count").cast("bigint").alias("aircraft_count"),
        F.col("rolling_mean").cast("double").alias("rolling_mean"),
        F.coalesce("anomaly_status", F.lit(NO_BASELINE)).alias("anomaly_status"),
    )


def recent_critical(items: DataFrame, n: int = 50) -> DataFrame:
    """The newest critical rows, as a SQL query over the serving view."""
    return items.sparkSession.sql(
        """
        SELECT region_pk, bucket_sk, aircraft_count, z_score, anomaly_direction
        FROM {traffic_by_region}
        WHERE anomaly_status = 'critical'
        ORDER BY bucket_sk DESC, region_pk
        LIMIT {n}
        """,
        traffic_by_region=items,
        n=n,
    )
