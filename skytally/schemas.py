"""Explicit schemas: nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BINARY": T.BinaryType(),
    "VECTORS": T.ArrayType(T.ArrayType(T.StringType())),
    "POSITIONS": T.MapType(T.StringType(), T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """``name TYPE, ...`` to a schema, without needing a session at import."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One poll response: every vector is an array of mixed values, read as text.
POLL = _struct("time BIGINT, states VECTORS")

# Position of each kept field in a state vector, with its type.
VECTOR_FIELDS = [
    ("icao24", 0, "string"),
    ("callsign", 1, "string"),
    ("origin_country", 2, "string"),
    ("longitude", 5, "double"),
    ("latitude", 6, "double"),
    ("baro_altitude", 7, "double"),
    ("on_ground", 8, "boolean"),
    ("velocity", 9, "double"),
    ("true_track", 10, "double"),
    ("vertical_rate", 11, "double"),
    ("geo_altitude", 13, "double"),
]

RECORD = _struct(
    "icao24 STRING, callsign STRING, origin_country STRING, longitude DOUBLE, latitude DOUBLE,"
    " baro_altitude DOUBLE, on_ground BOOLEAN, velocity DOUBLE, true_track DOUBLE,"
    " vertical_rate DOUBLE, geo_altitude DOUBLE, poll_timestamp BIGINT"
)

STATES = _struct(
    "icao24 STRING, callsign STRING, airline STRING, origin_country STRING, longitude DOUBLE,"
    " latitude DOUBLE, baro_altitude DOUBLE, velocity DOUBLE, true_track DOUBLE,"
    " vertical_rate DOUBLE, on_ground BOOLEAN, poll_timestamp BIGINT, nearest_region STRING"
)

# The 61 columns of a headerless event export, in file order.
EXPORT_COLUMNS = [
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode", "Actor1EthnicCode",
    "Actor1Religion1Code", "Actor1Religion2Code", "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode", "Actor2EthnicCode",
    "Actor2Religion1Code", "Actor2Religion2Code", "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_FullName", "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code", "Actor2Geo_ADM2Code",
    "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_ADM1Code", "ActionGeo_ADM2Code",
    "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID",
    "DATEADDED", "SOURCEURL",
]

# Files as Spark's binary file source delivers them; streams must name their schema.
FILES = _struct("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")

EVENTS = _struct(
    "global_event_id STRING, event_timestamp TIMESTAMP, actor1_name STRING, actor2_name STRING,"
    " event_code STRING, quad_class INT, goldstein_scale DOUBLE, num_mentions DOUBLE,"
    " num_sources DOUBLE, num_articles DOUBLE, action_geo_lat DOUBLE, action_geo_long DOUBLE,"
    " action_geo_country_code STRING, source_url STRING, nearest_region STRING"
)

COUNTS = _struct("region STRING, bucket_sk TIMESTAMP, aircraft_count BIGINT")

PAIRS = _struct("region STRING, bucket_sk TIMESTAMP, global_event_id STRING, mentions DOUBLE, goldstein_scale DOUBLE")

LATE = _struct("region STRING, bucket_sk TIMESTAMP")

SIGHTINGS = _struct("region STRING, bucket_sk TIMESTAMP, icao24 STRING")

TRAFFIC = _struct(
    "region STRING, bucket_sk TIMESTAMP, aircraft_count BIGINT, rolling_mean DOUBLE,"
    " rolling_std DOUBLE, baseline_n BIGINT, z_score DOUBLE, anomaly_status STRING,"
    " anomaly_direction STRING"
)

MANIFEST = _struct(
    "source_name STRING, source_etag STRING, last_fetched_at TIMESTAMP, last_key STRING,"
    " last_run_status STRING, shard_checkpoints POSITIONS"
)


def with_columns(schema: T.StructType, columns: str) -> T.StructType:
    """The schema plus trailing columns (partition columns of a stored table)."""
    return T.StructType(list(schema.fields) + list(_struct(columns).fields))
