"""Bronze to silver: state records and conflict events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.constants import BOX, MIN_QUAD_CLASS
from skytally.functions.geo import assign_nearest, in_box
from skytally.functions.numbers import to_double
from skytally.functions.text import airline_name
from skytally.functions.times import parse_compact
from skytally.schemas import EVENTS, STATES


def clean_states(records: DataFrame) -> DataFrame:
    """Drop records without a position, add operator and nearest region. Narrow, stream-safe."""
    placed = records.dropna(subset=["latitude", "longitude"])
    placed = assign_nearest(placed).withColumn("airline", airline_name(F.col("callsign")))
    return placed.select(*STATES.fieldNames())


def filter_box(df: DataFrame, lat: str, lon: str, box: dict = BOX) -> DataFrame:
    return df.filter(in_box(F.col(lat), F.col(lon), box))


def clean_events(raw: DataFrame, min_quad_class: int = MIN_QUAD_CLASS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text events to typed conflict events inside the box.

    Malformed numbers and times become NULL; a NULL position or class fails its filter.
    ``keep`` passes further columns through.
    """
    typed = raw.select(
        F.col("GLOBALEVENTID").alias("global_event_id"),
        parse_compact(F.col("DATEADDED")).alias("event_timestamp"),
        F.col("Actor1Name").alias("actor1_name"),
        F.col("Actor2Name").alias("actor2_name"),
        F.col("EventCode").alias("event_code"),
        to_double(F.col("QuadClass")).alias("__quad"),
        to_double(F.col("GoldsteinScale")).alias("goldstein_scale"),
        to_double(F.col("NumMentions")).alias("num_mentions"),
        to_double(F.col("NumSources")).alias("num_sources"),
        to_double(F.col("NumArticles")).alias("num_articles"),
        to_double(F.col("ActionGeo_Lat")).alias("action_geo_lat"),
        to_double(F.col("ActionGeo_Long")).alias("action_geo_long"),
        F.col("ActionGeo_CountryCode").alias("action_geo_country_code"),
        F.col("SOURCEURL").alias("source_url"),
        *keep,
    )
    # The cheap filters come before the distances.
    kept = filter_box(typed, "action_geo_lat", "action_geo_long").filter(F.col("__quad") >= min_quad_class)
    kept = kept.withColumn("quad_class", F.col("__quad").cast("int"))
    return assign_nearest(kept, "action_geo_lat", "action_geo_long").select(*EVENTS.fieldNames(), *keep)


def filter_any(df: DataFrame, column: str, selection: list | None) -> DataFrame:
    """Multi-value filter in which an empty selection means everything."""
    return df.filter(F.col(column).isin(list(selection))) if selection else df
