"""Conflict-event lists and markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.constants import (
    AIRPORTS,
    MENTIONS_CAP,
    NO_REGION,
    SEVERE_GOLDSTEIN,
    STATUS_COLOURS,
)

DISPLAY_COLUMNS = [
    "event_timestamp",
    "nearest_region",
    "actor1_name",
    "actor2_name",
    "event_code",
    "num_mentions",
    "goldstein_scale",
    "source_url",
]


def events_by_region_since(events: DataFrame, region: str, since: Column) -> DataFrame:
    return events.filter((F.col("nearest_region") == region) & (F.col("event_timestamp") >= since))


def events_all_regions(events: DataFrame, since: Column, regions: list[str] | None = None) -> DataFrame:
    """Events of every tracked region and of the space between them."""
    wanted = regions or [code for code, _, _ in AIRPORTS] + [NO_REGION]
    return events.filter(F.col("nearest_region").isin(wanted) & (F.col("event_timestamp") >= since))


def recent_events(events: DataFrame) -> DataFrame:
    """Display columns, newest first."""
    return events.select("global_event_id", *DISPLAY_COLUMNS).orderBy(F.desc("event_timestamp"), "global_event_id")


def top_events(events: DataFrame, n: int = 8) -> DataFrame:
    """The most mentioned events with marker size and colour, next to the number of all events."""
    mentions = F.coalesce("num_mentions", F.lit(1.0))
    goldstein = F.coalesce("goldstein_scale", F.lit(0.0))
    colour = F.when(goldstein < SEVERE_GOLDSTEIN, STATUS_COLOURS["critical"]).otherwise(STATUS_COLOURS["serious"])
    largest = (
        events.withColumn("num_mentions", mentions)
        .withColumn("goldstein_scale", goldstein)
        .orderBy(F.desc("num_mentions"), "global_event_id")
        .limit(n)
    )
    return largest.select(
        "global_event_id",
        "event_timestamp",
        "actor1_name",
        "actor2_name",
        "event_code",
        "num_mentions",
        "goldstein_scale",
        "source_url",
        (F.least("num_mentions", F.lit(float(MENTIONS_CAP))) / 3 + 8).alias("marker_size"),
        colour.alias("marker_colour"),
        events.agg(F.count("*")).scalar().alias("total_events"),
    )


def trend_overlay(history: DataFrame, events: DataFrame, n: int = 8) -> DataFrame:
    """Event markers placed just above the highest point of a traffic series (1 without one)."""
    top = history.agg(F.coalesce(F.max("aircraft_count") * 1.1, F.lit(1.0))).scalar()
    return top_events(events, n).withColumn("y", top)
