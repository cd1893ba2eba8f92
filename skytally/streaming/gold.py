"""Silver states to the gold traffic table, incrementally and with bounded state.

Two streams follow each other:

* ``count_buckets`` keeps the distinct sightings of the last hours, folded by the hour, and counts the buckets a micro-batch touched from
  these. Rows older than that are told apart by the greatest time seen, and their buckets are counted again from silver: exact for
  any lateness, while the work of a batch does not grow with history.
* ``score_buckets`` is a stateful processor with a ring of the last counts of each region. A change inside the ring is scored
  from the ring; only one that is older is scored from the stored table.

Batch N always writes the same versions, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from skytally.constants import ALERT_STATUSES, BUCKET_MINUTES, MAX_BASELINE_BUCKETS
from skytally.functions.times import bucket_epoch, bucket_start, sane_epoch
from skytally.operators.baseline import score_anomalies
from skytally.operators.dedup import merge_latest
from skytally.operators.history import KEYS, only_keys, rescore
from skytally.operators.traffic import aggregate_traffic
from skytally.schemas import COUNTS, LATE, SIGHTINGS, TRAFFIC, with_columns
from skytally.sources import files
from skytally.sources.keyed import KeyedTable
from skytally.sources.tables import read_log, write_batch
from skytally.streaming.ingest import read_silver_states

HORIZON_HOURS = 48  # how far behind the newest row sightings are kept
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _day():
    return F.date_format("bucket_sk", "yyyy-MM-dd")


def _month():
    return F.date_format("bucket_sk", "yyyy-MM")


def _hour():
    return F.date_format("bucket_sk", "yyyy-MM-dd-HH")


def traffic_table(spark: SparkSession, gold: str) -> KeyedTable:
    """The scored series by month, in a month by region and time: a filter on both reads the row groups it needs. A day would be a file of a few
    thousand rows, and late rows for many days cost a file each."""
    return KeyedTable(spark, f"{gold}/traffic", TRAFFIC, KEYS, _month, "month", cluster=KEYS)


def counts_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, COUNTS, KEYS, _day, cluster=KEYS)


def alerts_table(spark: SparkSession, gold: str) -> KeyedTable:
    """The alerts alone by month, in a month by status: a small index of the traffic table."""
    return KeyedTable(spark, f"{gold}/alerts", TRAFFIC, KEYS, _month, "month", cluster=["anomaly_status", "bucket_sk"])


def _moment(seconds: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(seconds=seconds)


def _name(seconds: int) -> str:
    """Part of the sightings an hour belongs to."""
    return _moment(seconds).strftime("%Y-%m-%d-%H").rjust(13, "0")


def sightings_table(spark: SparkSession, gold: str) -> KeyedTable:
    return KeyedTable(spark, f"{gold}/sightings", SIGHTINGS, SIGHTINGS.fieldNames(), _hour, part_name="hour")


def read_traffic(spark: SparkSession, gold: str) -> DataFrame:
    return traffic_table(spark, gold).read()


def index_alerts(spark: SparkSession, gold: str, months: Iterable[str], batch_id: int) -> None:
    """Bring the alerts of some months in line with the traffic table."""
    months = list(months)
    if months:
        current = traffic_table(spark, gold).read(min(months), max(months)).filter(_month().isin(months))
        alerts_table(spark, gold).replace(current.filter(F.col("anomaly_status").isin(ALERT_STATUSES)), months, batch_id)


def read_changes(spark: SparkSession, gold: str) -> DataFrame:
    return read_log(spark, f"{gold}/changes", COUNTS)


def read_alerts(spark: SparkSession, gold: str) -> DataFrame:
    return alerts_table(spark, gold).read()


# ---- counts -------------------------------------------------------------------------------------------


def _newest(spark: SparkSession, gold: str, before: int) -> int | None:
    """Greatest time in the batches before one, in epoch seconds."""
    known = [int(n) for n in files.names(spark, f"{gold}/newest") if n.isdigit() and int(n) < before]
    return int(files.get_text(spark, f"{gold}/newest/{max(known)}")) if known else None


def _note_newest(spark: SparkSession, gold: str, batch_id: int, newest: int) -> None:
    files.put_text(spark, f"{gold}/newest/{batch_id}", str(newest))
    for name in files.names(spark, f"{gold}/newest"):
        if name.isdigit() and int(name) < batch_id - 1:
            files.remove(spark, f"{gold}/newest/{name}")


def recount(spark: SparkSession, silver: str, buckets: DataFrame, bucket_minutes: int, days: Iterable[date] | None = None) -> DataFrame:
    """Counts of the (region, bucket) rows of ``buckets`` from silver: their days only, and in these their rows only."""
    if days is None:
        start, seconds = F.unix_seconds("bucket_sk"), F.lit(bucket_minutes * 60 - 1)
        first, last = (F.to_date(F.timestamp_seconds(s)) for s in (start, start + seconds))
        days = [r["day"] for r in buckets.select(F.explode(F.sequence(first, last)).alias("day")).distinct().collect()]
    states = read_silver_states(spark, silver).filter(F.col("dt").isin(sorted(days)))
    return aggregate_traffic(only_buckets(states, buckets, bucket_minutes), bucket_minutes)


def only_buckets(states: DataFrame, buckets: DataFrame, bucket_minutes: int) -> DataFrame:
    """States that fall into the (region, bucket) rows of ``buckets``."""
    marked = states.withColumn("__at", bucket_start(F.col("poll_timestamp"), bucket_minutes))
    wanted = buckets.select(F.col("region").alias("nearest_region"), F.col("bucket_sk").alias("__at"))
    return marked.join(wanted, ["nearest_region", "__at"], "left_semi").drop("__at")


def count_batch(
    spark: SparkSession,
    arrived: DataFrame,
    batch_id: int,
    silver: str,
    gold: str,
    bucket_minutes: int = BUCKET_MINUTES,
    horizon_hours: int = HORIZON_HOURS,
) -> None:
    """Store the new counts of the buckets that ``arrived`` rows fall into, as batch ``batch_id`` of the changes."""
    seen = arrived.select(
        F.col("nearest_region").alias("region"), bucket_start(F.col("poll_timestamp"), bucket_minutes).alias("bucket_sk"), "icao24"
    ).filter(F.col("region").isNotNull() & F.col("bucket_sk").isNotNull())
    seen = seen.distinct().persist()
    try:
        start = F.unix_seconds("bucket_sk")
        # One row an hour: all that has to be known of the batch.
        sizes = seen.groupBy((start - F.pmod(start, F.lit(3600))).alias("hour")).agg(F.max(start).alias("newest"), F.count("*").alias("n")).collect()
        if not sizes:
            return
        known = _newest(spark, gold, batch_id)
        newest = max([r["newest"] for r in sizes] + ([] if known is None else [known]))
        # Behind the newest row of this batch too, so a long backlog is counted from silver and does not pass through the sightings.
        kept = newest - newest % 3600 - horizon_hours * 3600
        hours = {_name(r["hour"]): r["n"] for r in sizes if r["hour"] >= kept}
        late = [r["hour"] for r in sizes if r["hour"] < kept]
        touched = seen.select(*KEYS).distinct()
        counts = []
        if hours:
            sightings = sightings_table(spark, gold)
            sightings.merge(seen.filter(start >= kept), batch_id, hours)
            rows = sightings.read(min(hours), max(hours)).join(touched, KEYS, "left_semi")
            counts.append(rows.groupBy(*KEYS).agg(F.count("icao24").alias("aircraft_count")))
            sightings.forget([p for p in sightings.parts() if p < _name(kept)], batch_id)
        if late:
            reach = 3600 + bucket_minutes * 60
            days = {_moment(s).date() for hour in late for s in range(hour, hour + reach, min(reach, 86400))}
            days |= {_moment(hour + reach).date() for hour in late}
            counts.append(recount(spark, silver, touched.filter(start < kept), bucket_minutes, days))
        write_batch(reduce(DataFrame.union, counts).select(*COUNTS.fieldNames()), f"{gold}/changes", batch_id)
        _note_newest(spark, gold, batch_id, newest)
    finally:
        seen.unpersist()


def count_buckets(
    states: DataFrame, silver: str, gold: str, checkpoint: str, bucket_minutes: int = BUCKET_MINUTES, horizon_hours: int = HORIZON_HOURS
) -> DataStreamWriter:
    """``states`` must be the stream over ``silver`` itself, so that silver holds its rows."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        count_batch(batch.sparkSession, batch, batch_id, silver, gold, bucket_minutes, horizon_hours)

    return states.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)


# ---- scores -------------------------------------------------------------------------------------------

RING = "at BIGINT, aircraft_count BIGINT, affected BOOLEAN, late BOOLEAN"


class Ring(StatefulProcessor):
    """The newest counts of a region, twice as many as a baseline holds.

    The newer half can change and be scored again, since the baselines of its rows are complete. Counts only grow, so of two for one
    bucket the greater is the newer. Emits the rows the scores need, marks those that are to be scored, and marks as late the changes
    that lie before the newer half of a series which the ring does not hold from its beginning.
    """

    def __init__(self, buckets: int = MAX_BASELINE_BUCKETS):
        self.buckets = buckets

    def init(self, handle) -> None:
        self.state = handle.getValueState("ring", "cut BOOLEAN, at ARRAY<BIGINT>, n ARRAY<BIGINT>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        cut, times, counts = self.state.get() if self.state.exists() else (False, [], [])
        held, before = dict(zip(times, counts)), {}
        changed = set()
        for frame in rows:
            for at, n in zip(frame["at"].tolist(), frame["aircraft_count"].tolist()):
                if cut and at < times[0]:
                    before[at] = max(n, before.get(at, 0))  # what lies between here and the ring is not known
                elif n > held.get(at, -1):
                    held[at] = n
                    changed.add(at)
        order = sorted(held)
        late, affected, needed = list(before.items()), set(), set()
        for i, at in enumerate(order):
            if at in changed:
                if cut and i < self.buckets:
                    late.append((at, held[at]))
                else:
                    affected.update(range(i, min(i + self.buckets + 1, len(order))))
                    needed.update(range(max(i - self.buckets, 0), min(i + self.buckets + 1, len(order))))
        out = [(order[i], held[order[i]], i in affected, False) for i in sorted(needed)] + [(at, n, True, True) for at, n in late]
        left = order[-2 * self.buckets :]
        self.state.update((cut or len(left) < len(order), left, [held[at] for at in left]))
        frame = pd.DataFrame(out, columns=["at", "aircraft_count", "affected", "late"])
        frame.insert(0, "region", key[0])
        yield frame

    def close(self) -> None:
        pass


def score_batch(spark: SparkSession, rings: DataFrame, batch_id: int, gold: str) -> None:
    """Store the scores that a batch of ring rows gives, as a batch of the table, of its alerts and of the log for serving."""
    rings = rings.withColumn("bucket_sk", F.timestamp_seconds("at")).persist()
    try:
        table = traffic_table(spark, gold)
        inside = rings.filter(~F.col("late"))
        scored = only_keys(score_anomalies(inside.select(*COUNTS.fieldNames())), inside.filter("affected"))
        late = rings.filter("late").select(*COUNTS.fieldNames())
        if not late.isEmpty():
            # The whole series of the regions concerned: which rows lie before a late one is not known otherwise.
            regions = late.select("region").distinct()
            stored = table.read().select(*COUNTS.fieldNames()).join(regions, "region", "left_semi")
            fresh = rings.filter("affected").select(*COUNTS.fieldNames()).join(regions, "region", "left_semi")
            again = rescore(merge_latest(stored, fresh, KEYS), late)
            scored = merge_latest(scored, again, KEYS)
        log = f"{gold}/scored/batch_id={batch_id}"
        scored.write.mode("overwrite").parquet(log)
        scored = spark.read.schema(TRAFFIC).parquet(log)
        index_alerts(spark, gold, table.merge(scored, batch_id), batch_id)
    finally:
        rings.unpersist()


def score_buckets(spark: SparkSession, gold: str, checkpoint: str, max_files: int | None = None) -> DataStreamWriter:
    """The stream over the changes that ``count_buckets`` stored."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)  # what a stateful processor needs
    reader = spark.readStream.schema(with_columns(COUNTS, "batch_id BIGINT"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    changes = reader.parquet(f"{gold}/changes").select("region", F.unix_seconds("bucket_sk").alias("at"), "aircraft_count")
    rings = changes.groupBy("region").transformWithStateInPandas(Ring(), f"region STRING, {RING}", "Update", "None")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch.sparkSession, batch, batch_id, gold)

    return rings.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)


# ---- windowed counts ------------------------------------------------------------------------------------


def _drop_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct rows of each Arrow batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        yield from rows.group_by(rows.column_names, use_threads=False).aggregate([]).to_batches()


def windowed_traffic(states: DataFrame, lateness: str, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Distinct aircraft per region and bucket with bounded state.

    Rows later than ``lateness`` are dropped by the watermark; ``late_buckets`` notes their buckets, and ``recounted`` adds what they
    are missing. Aircraft are deduplicated one by one, which
    spreads a crowded bucket over all state partitions. A streaming deduplication does not fold
    rows before its shuffle, so repeats are first dropped batch by batch: an aircraft that fills
    the feed then reaches its state partition as a few rows.
    """
    sightings = states.select(
        F.col("nearest_region").alias("region"),
        bucket_epoch(sane_epoch(F.col("poll_timestamp")), bucket_minutes).alias("start"),
        "icao24",
    )
    return (
        sightings.mapInArrow(_drop_repeats, "region STRING, start BIGINT, icao24 STRING")
        .select("region", F.timestamp_seconds("start").alias("ts"), "icao24")
        .withWatermark("ts", lateness)
        .select("region", F.window("ts", f"{bucket_minutes} minutes").alias("bucket"), "icao24")
        .dropDuplicates(["region", "bucket", "icao24"])
        .groupBy("region", "bucket")
        .agg(F.count("icao24").alias("aircraft_count"))
        .select("region", F.col("bucket.start").alias("bucket_sk"), "aircraft_count")
    )


def late_buckets(states: DataFrame, path: str, checkpoint: str, lateness_hours: float, bucket_minutes: int = BUCKET_MINUTES) -> DataStreamWriter:
    """Side output of ``windowed_traffic`` over the same stream: the buckets its watermark may refuse rows of.

    A bucket that ends ``lateness_hours`` or more before the greatest time up to and with its micro-batch is noted. The watermark only knows
    what came before a micro-batch, so no refused row is missed however the two streams cut their batches; a bucket noted without need
    is counted again and stays the same.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = batch.select(
            F.col("nearest_region").alias("region"), bucket_start(F.col("poll_timestamp"), bucket_minutes).alias("bucket_sk")
        ).dropna()
        keys = keys.distinct().persist()
        try:
            own, known = keys.agg(F.max(F.unix_seconds("bucket_sk"))).first()[0], _newest(spark, path, batch_id)
            if own is None:
                return
            newest = own if known is None else max(own, known)
            late = keys.filter(F.unix_seconds("bucket_sk") + bucket_minutes * 60 <= newest - int(lateness_hours * 3600))
            write_batch(late, f"{path}/late", batch_id)
            _note_newest(spark, path, batch_id, newest)
        finally:
            keys.unpersist()

    return states.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)


def recounted(spark: SparkSession, counts: DataFrame, path: str, silver: str, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """``counts`` of ``windowed_traffic`` with what it refused: the noted buckets are counted again from silver.

    Counts only grow, so of two counts of a bucket the greater is right."""
    late = read_log(spark, f"{path}/late", LATE).select(*KEYS).distinct()
    both = counts.select(*COUNTS.fieldNames()).union(recount(spark, silver, late, bucket_minutes))
    return both.groupBy(*KEYS).agg(F.max("aircraft_count").alias("aircraft_count"))


def upsert_counts(counts: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Update-mode sink: each batch stores the buckets whose count changed, the newest wins."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return counts.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
