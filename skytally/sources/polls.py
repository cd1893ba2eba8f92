"""Poll responses: one JSON object per file, holding an array of state vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.functions.numbers import nan_to_null
from skytally.functions.text import blank_to_null
from skytally.operators.cleaning import clean_states
from skytally.schemas import POLL, RECORD, STATES, VECTOR_FIELDS, with_columns
from skytally.sources.quarantine import CORRUPT, parsed, well_formed
from skytally.sources.files import has_files
from skytally.sources.tables import newest_file


FIELDS = with_columns(POLL, f"{CORRUPT} STRING")


def read_polls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file that holds a whole response. See ``malformed_polls`` for the others."""
    return well_formed(parsed(spark.read.text(path, wholetext=True), FIELDS), "malformed_polls")


def malformed_polls(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold no whole response, such as one that was cut off."""
    files = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    return parsed(files, FIELDS, "file").filter(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("body"))


def stream_polls(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return well_formed(parsed(reader.text(path, wholetext=True), FIELDS), "malformed_polls")


def _vector_parts(value: Column) -> tuple[Column, Column, Column]:
    """(text before the last bracket, text behind it, whether the piece holds a vector) of a piece of a response up to a closing bracket."""
    inner = F.substring_index(value, "[", -1)
    outer = F.expr("left(value, length(value) - length(substring_index(value, '[', -1)))")
    return outer, inner, value.contains("[") & (F.trim(inner) != "")


def scan_states(spark: SparkSession, path: str) -> DataFrame:
    """``flatten_states(read_polls(...))`` for responses of any size: no task holds more than a piece of one.

    The files are read up to each closing bracket, so every vector is a row of its own and a large file is read by several tasks. A
    response counts if its pieces are those of one whole response: an opening, vectors or nulls, and an end. Files whose
    vectors hold brackets of their own, in a text or a list, cannot be told apart this way and are read as a whole.
    """
    pieces = spark.read.text(path, lineSep="]").select("value", F.col("_metadata.file_path").alias("file"))
    outer, inner, is_vector = _vector_parts(F.col("value"))
    outside = F.when(is_vector, outer).otherwise(F.col("value"))
    opening = r'^\s*\{[^\[\]{}]*"states"\s*:\s*\[\s*(null\s*,\s*)*'
    fits = F.when(is_vector, outside.rlike(rf"({opening}\[|^(\s*,\s*null)*\s*,\s*\[)$")).otherwise(
        outside.rlike(rf'({opening}(null)?\s*$|^(\s*,\s*null)*\s*$|^\s*(,\s*"[^\[\]{{}}]*)?\}}\s*$|^\s*\{{[^\[\]{{}}]*\}}\s*$)')
    )
    vector = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>")
    good = fits & (~is_vector | vector.isNotNull())
    time = F.regexp_extract(outside, r'"time"\s*:\s*(-?\d+)', 1).try_cast("bigint")
    files = pieces.groupBy("file").agg(
        F.max(time).alias("time"),
        F.bool_and(F.coalesce(good, F.lit(False))).alias("plain"),
        F.count_if(outside.rlike(r"^\s*\{")).alias("openings"),
        F.count_if(~is_vector & outside.rlike(r"\}\s*$")).alias("ends"),
    )
    files = files.persist()  # one row a file
    split = files.filter("plain and openings = 1 and ends = 1").select("file", "time")
    vectors = pieces.filter(is_vector).select("file", vector.alias("v"))
    found = _fields(vectors.join(split, "file").withColumnRenamed("time", "poll_timestamp"))
    others = [r["file"] for r in files.filter("not plain").select("file").collect()]
    return found.union(flatten_states(read_polls(spark, others))) if others else found


def live_states(spark: SparkSession, live: str, bronze: str) -> tuple[DataFrame, str]:
    """Cleaned states to show now, and how fresh they are.

    The live poll if there is one, else the newest stored file, else nothing.
    """
    if has_files(spark, live):
        return clean_states(flatten_states(read_polls(spark, live))), "live"
    if has_files(spark, bronze):
        stored = newest_file(spark, bronze, "*.json")
        label = f"cached (from {stored.written} UTC)"
        return clean_states(spark.read.schema(RECORD).json(stored.path)), label
    return spark.createDataFrame([], STATES), "unavailable"


def flatten_states(polls: DataFrame) -> DataFrame:
    """One record per state vector that has an identifier, with or without a position."""
    return _fields(polls.select(F.col("time").alias("poll_timestamp"), F.explode("states").alias("v")))


def _fields(vectors: DataFrame) -> DataFrame:
    fields = []
    for name, position, kind in VECTOR_FIELDS:
        value = F.get("v", F.lit(position))
        if name == "callsign":
            value = blank_to_null(value)
        elif kind == "double":
            value = nan_to_null(value.try_cast(kind))
        elif kind != "string":
            value = value.try_cast(kind)
        fields.append(value.alias(name))
    return (
        vectors.filter(F.get("v", F.lit(0)) != "")
        .select(*fields, "poll_timestamp")
        .select(RECORD.fieldNames())
    )
