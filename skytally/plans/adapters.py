"""State vectors and conflict events derived from the ``events`` table.

The tables at hand hold no aircraft, so both feeds are computed from the whole ``events`` table.
Most expressions mean the same in Spark and in the checking engine and are shared as text; the
few that differ are given for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.operators.cleaning import clean_events, clean_states
from skytally.schemas import EXPORT_COLUMNS, RECORD, VECTOR_FIELDS
from skytally.sources.polls import flatten_states

STATE_EXPRESSIONS = {
    "event_id": "event_id",
    "icao24": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('ac', CAST(user_id AS VARCHAR(20))) END",
    "callsign": "CASE user_id % 10 WHEN 0 THEN 'UAE85' WHEN 1 THEN 'QTR12  ' WHEN 2 THEN 'ETD60K' WHEN 3 THEN 'sva7'"
    " WHEN 4 THEN 'AIC162' WHEN 5 THEN 'ZZZ999' WHEN 6 THEN 'XY123' WHEN 7 THEN 'T7ZAM' WHEN 8 THEN '   ' ELSE NULL END",
    "origin_country": "event_type",
    "longitude": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(31 AS DOUBLE)"
    " + CAST((user_id*53 + event_id*17) % 3231 AS DOUBLE)/CAST(100 AS DOUBLE) END",
    "latitude": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(12 AS DOUBLE)"
    " + CAST((user_id*37 + event_id*11) % 2551 AS DOUBLE)/CAST(100 AS DOUBLE) END",
    "baro_altitude": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value * CAST(30 AS DOUBLE) END",
    "on_ground": "event_id % 5 = 0",
    "velocity": "value",
    "true_track": "CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END",
    "vertical_rate": "CAST(event_id % 41 - 20 AS DOUBLE)/CAST(2 AS DOUBLE)",
    "geo_altitude": "value * CAST(31 AS DOUBLE)",
}
EPOCH = {"spark": "unix_seconds(CAST(ts AS TIMESTAMP))", "check": "CAST(floor(epoch(ts)) AS BIGINT)"}

CONFLICT_EXPRESSIONS = {
    "GLOBALEVENTID": "CAST(event_id AS VARCHAR(20))",
    "Actor1Name": "CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END",
    "Actor2Name": "CASE WHEN event_id % 3 = 0 THEN 'GOV' ELSE '' END",
    "EventCode": "CAST(100 + event_id % 90 AS VARCHAR(20))",
    "QuadClass": "CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE CAST(1 + event_id % 4 AS VARCHAR(20)) END",
    "GoldsteinScale": "CAST(CAST((event_id % 201) - 100 AS DOUBLE)/CAST(10 AS DOUBLE) AS VARCHAR(20))",
    "NumMentions": "CASE WHEN event_id % 43 = 0 THEN '' ELSE regexp_extract(props, '([0-9]+)', 1) END",
    "NumSources": "CAST(1 + event_id % 6 AS VARCHAR(20))",
    "NumArticles": "CASE WHEN event_id % 47 = 0 THEN '12d' ELSE CAST(1 + event_id % 9 AS VARCHAR(20)) END",
    "ActionGeo_CountryCode": "CASE WHEN event_id % 2 = 0 THEN 'SA' ELSE 'IZ' END",
    "ActionGeo_Lat": "CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(CAST(5 AS DOUBLE)"
    " + CAST((user_id*41 + event_id*7) % 4001 AS DOUBLE)/CAST(100 AS DOUBLE) AS VARCHAR(20)) END",
    "ActionGeo_Long": "CAST(CAST(25 AS DOUBLE)"
    " + CAST((user_id*59 + event_id*13) % 4501 AS DOUBLE)/CAST(100 AS DOUBLE) AS VARCHAR(20))",
    "SOURCEURL": "concat('http://example.org/', CAST(event_id AS VARCHAR(20)))",
}
DATE_ADDED = {
    "spark": "CASE WHEN event_id % 37 = 0 THEN '2024-bad' ELSE date_format(ts, 'yyyyMMddHHmmss') END",
    "check": "CASE WHEN event_id % 37 = 0 THEN '2024-bad' ELSE strftime(ts, '%Y%m%d%H%M%S') END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in expressions.items()])


def records_of(events: DataFrame) -> DataFrame:
    """Bronze-shaped records, with missing positions and identifiers; batch or stream."""
    return _project(events, {**STATE_EXPRESSIONS, "poll_timestamp": EPOCH["spark"]})


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "events"))


POSITIONS = {name: position for name, position, _ in VECTOR_FIELDS}


def polls_of(rows: DataFrame, *keep: str) -> DataFrame:
    """Poll responses: each record as a 17-value vector, next to a missing vector."""
    texts = {position: F.col(name).cast("string") for name, position in POSITIONS.items()}
    vector = F.array(*[texts.get(i, F.lit(None).cast("string")) for i in range(17)])
    missing = F.lit(None).cast("array<string>")
    return rows.select(F.col("poll_timestamp").alias("time"), F.array(vector, missing).alias("states"), *keep)


def bronze_of(rows: DataFrame) -> DataFrame:
    return flatten_states(polls_of(rows))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_of(records(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned states of identified aircraft."""
    return clean_states(bronze(spark, sf_dir))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned states straight from the records, so some identifiers are missing."""
    return clean_states(records(spark, sf_dir).select(*RECORD.fieldNames()))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text events as an export delivers them: an empty field is NULL."""
    texts = {**CONFLICT_EXPRESSIONS, "DATEADDED": DATE_ADDED["spark"]}
    fields = [F.nullif(F.expr(text), F.lit("")).alias(name) for name, text in texts.items()]
    return table(spark, sf_dir, "events").select("event_id", *fields)


def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines of 61 fields, as an export file holds them."""
    raw = raw_events(spark, sf_dir)
    cells = [F.coalesce(c, F.lit("")) if c in raw.columns else F.lit("") for c in EXPORT_COLUMNS]
    return raw.select(F.concat_ws("\t", *cells).alias("line"))


def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(raw_events(spark, sf_dir))
