"""Stored tables: batch-keyed Parquet logs, keyed reads, file listings and the manifest.

A keyed table is a log of batches (``batch_id=N`` directories). Writing batch N again replaces
exactly that directory, so a replay after a failure changes nothing; reading keeps the newest
row of each key. No write ever touches a path it reads from.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.operators.dedup import latest_by_key
from skytally.schemas import MANIFEST, with_columns
from skytally.sources import files


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str, schema: T.StructType, partitions: str = "") -> DataFrame:
    """All batches of a log, with ``batch_id``; an absent table is an empty one."""
    ddl = "batch_id BIGINT" + (f", {partitions}" if partitions else "")
    stored = with_columns(schema, ddl)
    try:
        return spark.read.schema(stored).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], stored)


def read_current(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], partitions: str = ""
) -> DataFrame:
    """Newest row per key. Filters on key columns still reach the scan."""
    log = read_log(spark, path, schema, partitions)
    return latest_by_key(log, keys, "batch_id").select(*schema.fieldNames())


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Rewrite the current rows as one batch of a new table, under the last batch number,
    so that later batches can continue there."""
    log = read_log(spark, path, schema)
    last = log.agg(F.max("batch_id")).first()[0] or 0
    write_batch(latest_by_key(log, keys, "batch_id").select(*schema.fieldNames()), target, last)


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Path, size and age of every file below ``path``; contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))
    )
    dt = F.regexp_extract("path", r"/dt=(\d{4}-\d{2}-\d{2})/", 1)
    return listing.withColumn("dt", F.nullif(dt, F.lit("")).cast("date"))


def newest(df: DataFrame, by: str) -> DataFrame:
    """Rows carrying the greatest value of ``by`` (the last poll, the last file)."""
    return df.filter(F.col(by) == df.agg(F.max(by)).scalar())


def newest_file(spark: SparkSession, path: str, glob: str = "*", folders: int | None = None) -> Row | None:
    """Listing row of the most recently written file (``written`` is its UTC time of day); only
    the listing is read, of the last ``folders`` dated folders if given."""
    dated = [name for name in files.names(spark, path) if name.startswith("dt=")] if folders else []
    listing = list_files(spark, [f"{path}/{name}" for name in dated[-folders:]] if dated else path, glob)
    listing = listing.withColumn("written", F.date_format("modified_at", "HH:mm"))
    return listing.orderBy(F.desc("modified_at"), F.desc("path")).first()


def read_newest_file(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*") -> DataFrame:
    """Rows of the most recently written NDJSON file; the others are not opened."""
    return spark.read.schema(schema).json(newest_file(spark, path, glob).path)


def unprocessed(listing: DataFrame, manifest: DataFrame, key: str = "file_name", force: bool = False) -> DataFrame:
    """Files the manifest does not know yet; ``force`` takes them all."""
    return listing if force else listing.join(manifest.select(key), key, "left_anti")


def expired_partitions(listing: DataFrame, as_of: str | Column, days: int) -> DataFrame:
    """``dt`` partitions older than ``days`` before ``as_of``. Deleting them is up to the caller (``drop_expired``)."""
    moment = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return listing.filter(F.col("dt") < F.date_sub(moment, days)).select("dt").distinct()


def drop_expired(spark: SparkSession, path: str, as_of: str, days: int, dry_run: bool = True) -> list[str]:
    """The ``dt=`` folders of ``path`` older than ``days`` before ``as_of``; they are removed only if ``dry_run`` is false."""
    limit = date.fromisoformat(as_of[:10]) - timedelta(days=days)
    old = [name for name in files.names(spark, path) if _dated(name) and _dated(name) < limit]
    for name in [] if dry_run else old:
        files.remove(spark, f"{path}/{name}")
    return old


def _dated(name: str) -> date | None:
    try:
        return date.fromisoformat(name[3:]) if name.startswith("dt=") else None
    except ValueError:
        return None


# ---- manifest: what each source delivered last ------------------------------------------------


def manifest_row(
    spark: SparkSession, source: str, etag: str | None, fetched_at: str, key: str, status: str,
    checkpoints: dict[str, str] | None = None,
) -> DataFrame:
    row = spark.createDataFrame([(source, etag or "", key, status, checkpoints)], _MANIFEST_INPUT)
    return row.withColumn("last_fetched_at", F.lit(fetched_at).cast("timestamp")).select(*MANIFEST.fieldNames())


_MANIFEST_INPUT = (
    "source_name STRING, source_etag STRING, last_key STRING, last_run_status STRING,"
    " shard_checkpoints MAP<STRING, STRING>"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    log = read_log(spark, path, MANIFEST, "source STRING")
    # Maps cannot be ordered, so the newest row is picked by batch number alone (unique per source).
    newest_row = F.max_by(F.struct(*MANIFEST.fieldNames()[1:]), "batch_id").alias("row")
    return log.groupBy("source_name").agg(newest_row).select("source_name", "row.*")


def stored_etag(manifest: DataFrame, source: str) -> DataFrame:
    """At most one row: the last etag of a source."""
    return manifest.filter(F.col("source_name") == source).select("source_etag")


def merge_checkpoints(old: Column, new: Column) -> Column:
    """Per-shard positions, the new one winning; either map may be missing."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_zip_with(
        F.coalesce(old, empty), F.coalesce(new, empty), lambda _, before, after: F.coalesce(after, before)
    )
