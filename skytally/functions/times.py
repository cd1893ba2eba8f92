"""Time expressions. All times are UTC; nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_epoch(seconds: Column, minutes: int) -> Column:
    """Epoch seconds floored to the start of their bucket."""
    return seconds - F.pmod(seconds, F.lit(minutes * 60))


# Years 1 to 9999: what a timestamp column can hold in every engine that reads the tables.
FIRST_EPOCH, LAST_EPOCH = -62135596800, 253402300799


def sane_epoch(seconds: Column) -> Column:
    """NULL for a time far off; converting it would stop the job."""
    return F.when(seconds.between(FIRST_EPOCH, LAST_EPOCH), seconds)


def bucket_start(seconds: Column, minutes: int) -> Column:
    """NULL for a time far off."""
    return F.timestamp_seconds(bucket_epoch(sane_epoch(seconds), minutes))


def parse_compact(text: Column) -> Column:
    """``yyyyMMddHHmmss`` text to a timestamp, NULL when malformed."""
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_offset(ts: Column) -> Column:
    """ISO text with an explicit zero offset, fine to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def hours_before(as_of: str, hours: float) -> Column:
    """A cutoff relative to a given moment (never to the clock, so results repeat)."""
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(int(round(hours * 60))))


def partition_date(seconds: Column) -> Column:
    """NULL for a time far off, so such rows are stored apart."""
    return F.to_date(F.timestamp_seconds(sane_epoch(seconds)))
