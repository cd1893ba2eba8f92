"""Reading the region time series back, and scoring only what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.constants import MAX_BASELINE_BUCKETS, MIN_BASELINE_BUCKETS, NO_BASELINE, SEVERITY_ORDER
from skytally.functions.times import hours_before
from skytally.operators.baseline import CHUNK_SECONDS, number_series, score_anomalies
from skytally.operators.dedup import merge_latest

KEYS = ["region", "bucket_sk"]


def region_history(traffic: DataFrame, region: str, as_of: str, hours: float) -> DataFrame:
    """One region's buckets since a cutoff, oldest first; both conditions reach the scan."""
    return (
        traffic.filter((F.col("region") == region) & (F.col("bucket_sk") >= hours_before(as_of, hours)))
        .select("bucket_sk", "aircraft_count", "rolling_mean", "anomaly_status")
        .orderBy("bucket_sk")
    )


def latest_status(traffic: DataFrame) -> DataFrame:
    """Current status per region, by partial aggregation without a window or a sort.

    The status travels as a number, because only values of fixed width are folded by hash.
    """
    names = F.array(*map(F.lit, SEVERITY_ORDER))
    code = F.array_position(names, F.coalesce("anomaly_status", F.lit(NO_BASELINE))).cast("int")
    newest = traffic.groupBy("region").agg(F.max_by(code, "bucket_sk").alias("code"), F.max("bucket_sk").alias("bucket_sk"))
    return newest.select("region", F.get(names, F.col("code") - 1).alias("anomaly_status"), "bucket_sk")


def status_as_of(traffic: DataFrame, moment: str | Column, regions: DataFrame) -> DataFrame:
    """Status of every listed region at a past moment; a region without history gets the default."""
    at = F.lit(moment).cast("timestamp") if isinstance(moment, str) else moment
    past = latest_status(traffic.filter(F.col("bucket_sk") <= at)).select("region", "anomaly_status")
    return regions.select("region").join(past, "region", "left").select(
        "region", F.coalesce("anomaly_status", F.lit(NO_BASELINE)).alias("anomaly_status")
    )


def recent_history(traffic: DataFrame, regions: DataFrame | None = None, buckets: int = MAX_BASELINE_BUCKETS) -> DataFrame:
    """The last ``buckets`` rows of each region, oldest first.

    Each week of a region is limited first, which Spark does inside every input split before the shuffle; the
    windows over whole regions see at most ``buckets`` rows of each week.
    """
    week = F.floor(F.unix_seconds("bucket_sk") / CHUNK_SECONDS)
    newest_first = Window.partitionBy("region", "__week").orderBy(F.col("bucket_sk").desc())
    rows = traffic.withColumn("__week", week).withColumn("__rank", F.row_number().over(newest_first)).filter(F.col("__rank") <= buckets)
    # A region's newest weeks that hold enough rows; a sum over weeks, not rows.
    weeks = rows.groupBy("region", "__week").agg(F.count("*").alias("n"))
    later = Window.partitionBy("region").orderBy(F.desc("__week")).rowsBetween(Window.unboundedPreceding, -1)
    weeks = weeks.withColumn("later", F.coalesce(F.sum("n").over(later), F.lit(0))).filter(F.col("later") < buckets)
    if regions is not None:
        weeks = weeks.join(regions.select("region").distinct(), "region", "left_semi")
    return (
        rows.join(weeks.select("region", "__week", "later"), ["region", "__week"])
        .filter(F.col("later") + F.col("__rank") <= buckets)
        .select("region", "bucket_sk", "aircraft_count")
        .orderBy("region", "bucket_sk")
    )


def only_keys(scored: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose (region, bucket) occurs in ``keys``."""
    return scored.join(keys.select(*KEYS), KEYS, "left_semi")


def rescore(
    counts: DataFrame,
    changed: DataFrame,
    max_buckets: int = MAX_BASELINE_BUCKETS,
    min_buckets: int = MIN_BASELINE_BUCKETS,
) -> DataFrame:
    """New scores of every row that the ``changed`` (region, bucket) keys can affect, and of no other.

    A change moves its own row and the ``max_buckets`` rows after it, and these look back as far. The
    numbered series is cut into blocks of that many rows: a change in block b needs the blocks b - 1 to b + 1, so two changes
    far apart do not bring in what lies between them. No task holds more than a week or a few blocks of a region.
    """
    numbered = number_series(counts.join(changed.select("region").distinct(), "region", "left_semi").select(*KEYS, "aircraft_count"))
    numbered = numbered.withColumn("block", F.floor(F.col("idx") / max_buckets))
    moved = numbered.join(changed.select(*KEYS).distinct(), KEYS)
    spots = moved.groupBy("region", "block").agg(F.min("idx").alias("first"), F.max("idx").alias("last"))
    near = spots.select("region", F.explode(F.array(*[F.col("block") + k for k in (-1, 0, 1)])).alias("block")).distinct()
    needed = numbered.join(near, ["region", "block"], "left_semi")
    own = spots.select("region", "block", "first")
    before = spots.select("region", (F.col("block") + 1).alias("block"), "last")
    marked = needed.join(own, ["region", "block"], "left").join(before, ["region", "block"], "left")
    affected = marked.filter((F.col("first") <= F.col("idx")) | (F.col("idx") - F.col("last") <= max_buckets))
    scored = score_anomalies(needed.select(*KEYS, "aircraft_count"), max_buckets, min_buckets)
    return scored.join(affected.select(*KEYS), KEYS, "left_semi")


def incremental_score(
    history: DataFrame,
    new: DataFrame,
    max_buckets: int = MAX_BASELINE_BUCKETS,
    min_buckets: int = MIN_BASELINE_BUCKETS,
) -> DataFrame:
    """Scores of the new buckets against stored history; a new bucket replaces a stored one."""
    columns = [*KEYS, "aircraft_count"]
    combined = merge_latest(history.select(columns), new.select(columns), KEYS)
    return only_keys(rescore(combined, new, max_buckets, min_buckets), new)


def alerts_by_status(traffic: DataFrame, status: str) -> DataFrame:
    return traffic.filter(F.col("anomaly_status") == status).orderBy("bucket_sk", "region")


def baseline_series(history: DataFrame) -> DataFrame:
    return history.dropna(subset=["rolling_mean"])
