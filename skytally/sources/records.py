"""Records as newline-delimited JSON (the bronze form), partitioned by ``dt``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions.times import bucket_epoch, partition_date
from skytally.schemas import RECORD, with_columns
from skytally.sources.quarantine import CORRUPT, parsed, well_formed

LINES = "value STRING, dt DATE"
FIELDS = with_columns(RECORD, f"{CORRUPT} STRING")


def _split(lines: DataFrame) -> DataFrame:
    """Each line parsed; ``CORRUPT`` holds a line that is not one whole object."""
    return parsed(lines.filter(F.trim("value") != ""), FIELDS, "dt")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Well-formed records; blank lines are skipped and missing fields read as NULL. See ``malformed_records`` for the rest."""
    return well_formed(_split(spark.read.schema(LINES).text(path)), "malformed_records")


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_records`` leaves out."""
    return _split(spark.read.schema(LINES).text(path)).filter(F.col(CORRUPT).isNotNull()).select("dt", F.col(CORRUPT).alias("body"))


def stream_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LINES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return well_formed(_split(reader.text(path)), "malformed_records")


def encode(records: DataFrame, out: str = "value") -> DataFrame:
    """Keyed messages: ``key`` is the identifier, the body one JSON object (NULLs kept out)."""
    body = F.to_json(F.struct(*RECORD.fieldNames()))
    return records.select(F.col("icao24").alias("key"), body.alias(out))


def decode(messages: DataFrame, body: str = "value") -> DataFrame:
    return messages.select(F.from_json(F.col(body).cast("string"), RECORD).alias("r")).select("r.*")


def spread(records: DataFrame, partitions: int) -> DataFrame:
    """Records of one aircraft and hour together, as a keyed stream would hold them.

    The hour keeps an identifier that dominates the feed from filling a single partition.
    """
    hour = bucket_epoch(F.col("poll_timestamp"), 60)
    return records.repartition(partitions, F.col("icao24"), hour)


def write_records(records: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append records as NDJSON under ``dt=``, spread over ``partitions`` files a day if given."""
    rows = spread(records, partitions) if partitions else records
    rows.withColumn("dt", partition_date(F.col("poll_timestamp"))).write.mode("append").partitionBy("dt").json(path)
