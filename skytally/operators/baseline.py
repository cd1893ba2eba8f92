"""Rolling baseline over preceding buckets, and the anomaly score built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.constants import MAX_BASELINE_BUCKETS, MIN_BASELINE_BUCKETS
from skytally.functions.scoring import direction, tier, z_score
from skytally.schemas import TRAFFIC

# A chunk is the unit a series is numbered in, a block the unit its windows run in. Both bound
# the rows one task must hold whatever the length of a region's history.
CHUNK_SECONDS = 7 * 24 * 3600
BLOCK_ROWS = 4096


def number_series(traffic: DataFrame) -> DataFrame:
    """Add ``idx``, the position of each bucket in its region's series (0 is the oldest).

    Each week of a region is numbered on its own and shifted by the number of rows before it, so
    no task sees a whole series. A week holds at most one row per bucket, which bounds the arrays.
    """
    chunk = F.floor(F.unix_seconds("bucket_sk") / CHUNK_SECONDS)
    packed = (
        traffic.withColumn("chunk", chunk)
        .filter(F.col("region").isNotNull() & F.col("chunk").isNotNull())
        .groupBy("region", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("bucket_sk", "aircraft_count"))).alias("points"))
    )
    before = Window.partitionBy("region").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per region and week. Both sides of the join below read the same shuffle of
    # ``packed``: the filter above states what the join would otherwise add to one side only.
    offsets = packed.select("region", "chunk", F.size("points").alias("n")).select(
        "region", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return (
        packed.join(offsets, ["region", "chunk"])
        .select("region", "offset", F.posexplode("points").alias("pos", "point"))
        .select("region", "point.*", (F.col("offset") + F.col("pos")).alias("idx"))
    )


def rolling_baseline(
    traffic: DataFrame,
    max_buckets: int = MAX_BASELINE_BUCKETS,
    min_buckets: int = MIN_BASELINE_BUCKETS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean, sample deviation and size of the preceding buckets (never the current one).

    The series is cut into blocks of ``block_rows``; the last ``max_buckets`` rows of a block are
    also sent to the next one, where they only serve as history. Every frame is thus complete
    inside its block and the result equals one window over the whole region.
    """
    block_rows = max(block_rows, max_buckets)
    block = F.floor(F.col("idx") / block_rows)
    reaches_next = F.pmod("idx", F.lit(block_rows)) >= block_rows - max_buckets
    targets = F.when(reaches_next, F.array(block, block + 1)).otherwise(F.array(block))
    spread = number_series(traffic).withColumn("block", F.explode(targets))
    preceding = Window.partitionBy("region", "block").orderBy("idx").rowsBetween(-max_buckets, -1)
    count = F.col("aircraft_count")
    framed = spread.select(
        "region",
        "bucket_sk",
        "aircraft_count",
        (F.col("block") > block).alias("is_history"),
        F.count(count).over(preceding).alias("baseline_n"),
        F.avg(count).over(preceding).alias("mean"),
        F.stddev_samp(count).over(preceding).alias("std"),
    ).filter(~F.col("is_history"))
    enough = F.col("baseline_n") >= min_buckets
    return framed.select(
        "region",
        "bucket_sk",
        "aircraft_count",
        F.when(enough, F.col("mean")).alias("rolling_mean"),
        F.when(enough, F.col("std")).alias("rolling_std"),
        "baseline_n",
    )


def score_anomalies(
    traffic: DataFrame,
    max_buckets: int = MAX_BASELINE_BUCKETS,
    min_buckets: int = MIN_BASELINE_BUCKETS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Score every bucket of every region against its own baseline; regions are independent."""
    scored = rolling_baseline(traffic, max_buckets, min_buckets, block_rows)
    scored = scored.withColumn("z_score", z_score(F.col("aircraft_count"), F.col("rolling_mean"), F.col("rolling_std")))
    scored = scored.withColumn("anomaly_status", tier(F.col("z_score")))
    scored = scored.withColumn("anomaly_direction", direction(F.col("z_score"), F.col("anomaly_status")))
    return scored.select(*TRAFFIC.fieldNames())
