"""Dashboard aggregates over a set of states, a traffic table or events.

All of them are plain aggregates: rows are folded inside each input split, and what crosses the
network is at most one row per region, operator or zone and split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.constants import (
    AFFECTED_AIRLINES,
    AIRLINE_COLOURS,
    ALERT_STATUSES,
    ALTITUDE_BANDS,
    DETOUR_MINUTES_HIGH,
    DETOUR_MINUTES_LOW,
    FUEL_USD_PER_HOUR,
    OPERATING_USD_PER_HOUR,
    OTHER_COLOUR,
    STATUS_COLOURS,
    STATUS_ICONS,
    UNKNOWN_ICON,
)
from skytally.functions.geo import zone_of
from skytally.functions.numbers import metres_per_second_to_knots, metres_to_feet
from skytally.functions.scoring import severity_rank
from skytally.functions.text import lookup


def count_by(df: DataFrame, column: str, out: str = "aircraft") -> DataFrame:
    """Rows per value; NULL is not a value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))


def top_by_count(df: DataFrame, column: str, n: int, out: str = "aircraft") -> DataFrame:
    """The ``n`` most frequent values; ties by name."""
    return count_by(df, column, out).orderBy(F.desc(out), column).limit(n)


def airline_list(states: DataFrame) -> DataFrame:
    return states.select("airline").distinct().orderBy("airline")


def kpi_summary(states: DataFrame) -> DataFrame:
    """Tracked aircraft, active operators and the busiest region, from one pass."""
    by_pair = states.groupBy("nearest_region", "airline").agg(F.count("*").alias("n"))
    by_region = by_pair.groupBy("nearest_region").agg(
        F.sum("n").alias("n"), F.collect_set("airline").alias("airlines")
    )
    busiest = F.min(F.struct(-F.col("n"), F.col("nearest_region").alias("region")))
    return by_region.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("aircraft"),
        F.size(F.array_distinct(F.flatten(F.collect_list("airlines")))).alias("airlines"),
        busiest["region"].alias("busiest_region"),
    )


def alert_count(current: DataFrame) -> DataFrame:
    """Regions whose current status is warning or worse."""
    return current.agg(F.count_if(F.col("anomaly_status").isin(ALERT_STATUSES)).alias("alerts"))


def status_counts(current: DataFrame) -> DataFrame:
    """Regions per status, worst first; a status nobody has is absent."""
    return (
        current.groupBy("anomaly_status")
        .agg(F.count("*").alias("regions"))
        .withColumn("severity", severity_rank(F.col("anomaly_status")))
        .orderBy("severity")
    )


def alert_board(current: DataFrame) -> DataFrame:
    """Badges for the current status of each region, worst first."""
    status = F.col("anomaly_status")
    return current.select(
        "region",
        "anomaly_status",
        severity_rank(status).alias("severity"),
        lookup(STATUS_COLOURS, status, OTHER_COLOUR).alias("colour"),
        lookup(STATUS_ICONS, status, UNKNOWN_ICON).alias("icon"),
    ).orderBy("severity", "region")


def with_zone(states: DataFrame) -> DataFrame:
    return states.withColumn("zone", zone_of(F.col("latitude"), F.col("longitude")))


def zone_counts(states: DataFrame) -> DataFrame:
    return count_by(with_zone(states), "zone")


def zone_total(states: DataFrame) -> DataFrame:
    """Aircraft inside any zone, and their share of all."""
    inside = F.count_if(F.col("zone").isNotNull())
    return with_zone(states).agg(inside.alias("aircraft"), (inside / F.count("*")).alias("share"))


def altitude_speed(states: DataFrame) -> DataFrame:
    """Mean altitude in feet and speed in knots, missing values left out; no row without altitudes."""
    means = states.agg(F.avg("baro_altitude").alias("metres"), F.avg("velocity").alias("speed"))
    return means.filter(F.col("metres").isNotNull()).select(
        metres_to_feet(F.col("metres")).alias("altitude_ft"),
        metres_per_second_to_knots(F.col("speed")).alias("speed_kt"),
    )


def altitude_bands(states: DataFrame) -> DataFrame:
    """Right-closed altitude bands; every band is listed, an empty one as 0."""
    metres = F.col("baro_altitude")
    counts = [
        F.count_if((metres > low) & (metres <= high)).alias(f"n{i}") for i, (_, low, high) in enumerate(ALTITUDE_BANDS)
    ]
    pairs = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("band"), F.col(f"n{i}").alias("aircraft"))
        for i, (label, _, _) in enumerate(ALTITUDE_BANDS)
    ]
    return states.agg(*counts).select(F.inline(F.array(*pairs)))


def event_counts(events: DataFrame, since: Column, n: int = 5) -> DataFrame:
    """Events since a cutoff: the ``n`` busiest regions, each next to the overall total."""
    everything = Window.partitionBy(F.lit(0))  # over one row per region
    return (
        events.filter(F.col("event_timestamp") >= since)
        .groupBy("nearest_region")
        .agg(F.count("*").alias("events"))
        .withColumn("total_events", F.sum("events").over(everything))
        .filter(F.col("nearest_region").isNotNull())
        .orderBy(F.desc("events"), "nearest_region")
        .limit(n)
    )


def detour_cost(
    states: DataFrame, use_full_operating_cost: bool = False, airlines: list[str] = AFFECTED_AIRLINES
) -> DataFrame:
    """Cost range of the flights on affected operators (half-even rounding)."""
    rate = OPERATING_USD_PER_HOUR if use_full_operating_cost else FUEL_USD_PER_HOUR
    flights = F.col("affected_flights")

    def usd(minutes: int) -> Column:
        return F.bround(flights * F.lit(minutes / 60) * F.lit(rate)).cast("bigint")

    affected = states.filter(F.col("airline").isin(list(airlines))).agg(F.count("*").alias("affected_flights"))
    return affected.select(
        "affected_flights",
        usd(DETOUR_MINUTES_LOW).alias("low_usd"),
        usd(DETOUR_MINUTES_HIGH).alias("high_usd"),
        F.lit(rate).alias("per_hour_usd"),
    )


def region_detail(history: DataFrame) -> DataFrame:
    """Latest count, window mean, their difference and the number of buckets; no row without history."""
    summary = history.agg(
        F.max_by("aircraft_count", "bucket_sk").alias("latest_count"),
        F.avg("aircraft_count").alias("mean_count"),
        F.count("*").alias("buckets"),
    )
    return summary.filter(F.col("buckets") > 0).withColumn("delta", F.col("latest_count") - F.col("mean_count"))


def ranked_labels(df: DataFrame, column: str, out: str = "aircraft") -> DataFrame:
    """All values ranked ascending; the three largest counts carry a label (so ties may add more).

    With fewer than three values only the maximum is labelled.
    """
    counts = count_by(df, column, out)
    # One row per region or operator is left here, so the unpartitioned frame is small.
    everything = Window.partitionBy(F.lit(0))
    ranked = counts.select(
        column,
        out,
        F.rank().over(everything.orderBy(F.desc(out))).alias("rank"),
        F.count("*").over(everything).alias("values"),
    )
    labelled = F.col("rank") <= F.when(F.col("values") >= 3, 3).otherwise(1)
    return ranked.select(
        column, out, "rank", F.when(labelled, F.col(out).cast("string")).otherwise("").alias("label")
    ).orderBy(out, column)


def airline_colour(airline: Column) -> Column:
    return lookup(AIRLINE_COLOURS, airline, OTHER_COLOUR)


def top_airlines(states: DataFrame, n: int = 6) -> DataFrame:
    """The largest operators with their colour and their share of the rows shown."""
    shown = Window.partitionBy(F.lit(0))  # over the n rows shown
    return top_by_count(states, "airline", n).select(
        "airline",
        "aircraft",
        airline_colour(F.col("airline")).alias("colour"),
        (F.col("aircraft") / F.sum("aircraft").over(shown)).alias("share"),
    )


def top_airlines_bar(states: DataFrame, n: int = 8) -> DataFrame:
    """The largest operators in ascending order, for horizontal bars, with top-three labels."""
    ranked = ranked_labels(states, "airline").orderBy(F.desc("aircraft"), F.desc("airline")).limit(n)
    return ranked.withColumn("colour", airline_colour(F.col("airline"))).orderBy("aircraft", "airline")
