"""Tables behind the live map."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.constants import (
    AIRLINE_COLOURS,
    AIRPORTS,
    HALO_RGBA,
    MAP_COLOURED_AIRLINES,
    NO_BASELINE,
    OTHER_COLOUR,
    ZONE_FILL,
    ZONES,
)
from skytally.functions.text import hex_to_rgba, lookup
from skytally.operators.kpis import with_zone


def airports(spark: SparkSession) -> DataFrame:
    """Reference airports as a table (15 constant rows)."""
    codes, latitudes, longitudes = zip(*AIRPORTS)
    columns = {"region": codes, "latitude": latitudes, "longitude": longitudes}
    return spark.createDataFrame(pa.table({name: list(values) for name, values in columns.items()}))


def zones(spark: SparkSession) -> DataFrame:
    """Zones with their ring: four [lon, lat] corners, the first not repeated (3 constant rows)."""
    rings = [[[west, south], [east, south], [east, north], [west, north]] for _, south, north, west, east in ZONES]
    names = [zone[0] for zone in ZONES]
    fills = pa.array([ZONE_FILL[name] for name in names], pa.list_(pa.int32()))
    return spark.createDataFrame(pa.table({"zone": names, "polygon": rings, "fill": fills}))


def map_points(states: DataFrame) -> DataFrame:
    """Aircraft with heading and colour; only the first few operators have their own colour."""
    coloured = dict(list(AIRLINE_COLOURS.items())[:MAP_COLOURED_AIRLINES])
    return states.withColumns(
        {
            "angle": F.coalesce("true_track", F.lit(0.0)),
            "colour": hex_to_rgba(lookup(coloured, F.col("airline"), OTHER_COLOUR)),
        }
    )


def zone_polygons(states: DataFrame) -> DataFrame:
    """Every zone's ring and fill with the number of aircraft inside."""
    counts = with_zone(states).groupBy("zone").agg(F.count("*").alias("aircraft"))
    return (
        zones(states.sparkSession)
        .join(counts, "zone", "left")
        .select("zone", "polygon", "fill", F.coalesce("aircraft", F.lit(0)).alias("aircraft"))
    )


def airport_halos(current: DataFrame) -> DataFrame:
    """All airports with their current status and halo colour; no status yet means the default."""
    status = F.coalesce("anomaly_status", F.lit(NO_BASELINE))
    return (
        airports(current.sparkSession)
        .join(current.select("region", "anomaly_status"), "region", "left")
        .select("region", "latitude", "longitude", status.alias("anomaly_status"))
        .withColumn("halo", lookup(HALO_RGBA, F.col("anomaly_status")))
    )


def corridors(states: DataFrame) -> DataFrame:
    """A line from each aircraft to its named airport, in the aircraft's colour, see-through.

    The airports are 15 constant rows, so broadcasting them is safe at any size of ``states``.
    """
    targets = airports(states.sparkSession).select(
        F.col("region").alias("nearest_region"),
        F.col("latitude").alias("target_latitude"),
        F.col("longitude").alias("target_longitude"),
    )
    return (
        map_points(states)
        .join(F.broadcast(targets), "nearest_region")
        .withColumn("colour", F.concat(F.slice("colour", 1, 3), F.array(F.lit(90))))
    )
