"""Input that cannot be used as it is: found, named and counted, while the rest goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.numbers import to_exact_decimal
from skytally.functions.times import FIRST_EPOCH, LAST_EPOCH

CORRUPT = "corrupt"


def parsed(lines: DataFrame, fields: T.StructType, *keep: str) -> DataFrame:
    """JSON texts (column ``value``) as columns; ``CORRUPT`` holds a text that does not parse, whose other columns are NULL."""
    fields = T.StructType([f for f in fields if f.name not in keep])
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    return lines.select(F.from_json("value", fields, options).alias("r"), *keep).select("r.*", *keep)


def well_formed(rows: DataFrame, name: str) -> DataFrame:
    """Rows that parsed; a stream counts the others as ``name``, to be seen in its progress."""
    if rows.isStreaming:
        rows = rows.observe(name, F.count_if(F.col(CORRUPT).isNotNull()).alias(name))
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def reason() -> Column:
    """Why a record is set aside, NULL for a good one: a position off the globe or a time far off."""
    lat, lon, at = F.col("latitude"), F.col("longitude"), F.col("poll_timestamp")
    off = ~(lat.between(-90, 90) & lon.between(-180, 180))
    return F.when(off, "position").when(~at.between(FIRST_EPOCH, LAST_EPOCH), "time")


def set_aside(records: DataFrame) -> DataFrame:
    """Records with the reason they cannot be placed or dated. They stay in the cleaned table as well, in region
    ``OTHER`` or without a bucket; this is the list to look at and to count."""
    return records.withColumn("reason", reason()).filter(F.col("reason").isNotNull())


def inexact(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with a number that no exact decimal holds (its attribute is left out of the serving item), one per such column."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in columns]))
    found = rows.select("*", each.alias("e")).select(*rows.columns, "e.*")
    bad = F.col("number").isNotNull() & ~F.isnan("number") & to_exact_decimal(F.col("number")).isNull()
    return found.filter(bad)
