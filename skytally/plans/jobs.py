"""The jobs: landing to silver, silver to gold, gold to serving, and all of them in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.constants import BUCKET_MINUTES
from skytally.operators.baseline import score_anomalies
from skytally.operators.cleaning import clean_events, clean_states
from skytally.operators.dedup import latest_by_key
from skytally.operators.history import KEYS
from skytally.operators.serving import serving_events, serving_traffic
from skytally.operators.traffic import aggregate_traffic
from skytally.schemas import EVENTS, TRAFFIC, with_columns
from skytally.sources import files
from skytally.sources.exports import export_version, stream_exports
from skytally.sources.keyed import KeyedTable
from skytally.sources.polls import stream_polls
from skytally.sources.records import stream_records
from skytally.sources.tables import manifest_row, read_log, write_batch
from skytally.streaming import gold as gold_stream
from skytally.streaming import ingest


def bronze_to_silver(records: DataFrame, exports: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Batch form: the same transforms the streams use. A missing source stays missing."""
    return clean_states(records), None if exports is None else clean_events(exports)


def silver_to_gold(states: DataFrame, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Batch form: the whole scored traffic table."""
    return score_anomalies(aggregate_traffic(states, bucket_minutes))


VERSIONED_EVENTS = with_columns(EVENTS, "version BIGINT")
ID_SPAN = 100_000  # event numbers in one part of a table of events


def _versioned(log: DataFrame) -> DataFrame:
    return log.withColumn("version", export_version(F.col("source_file"), F.col("batch_id"))).select(*VERSIONED_EVENTS.fieldNames())


def current_events(log: DataFrame) -> DataFrame:
    """Events promoted to gold: overlapping exports repeat an event, the newest export wins."""
    return latest_by_key(_versioned(log), ["global_event_id"], "version").select(*EVENTS.fieldNames())


def _span(number: str):
    """Events by their number, which grows with time: a new export touches the last parts."""
    whole = F.col(number).try_cast("bigint")
    return F.coalesce(F.floor(whole / ID_SPAN).cast("string"), F.lit("other"))


def events_table(spark: SparkSession, gold: str) -> KeyedTable:
    keys, part = ["global_event_id"], lambda: _span("global_event_id")
    cluster = ["nearest_region", "event_timestamp"]
    return KeyedTable(spark, f"{gold}/events", VERSIONED_EVENTS, keys, part, "ids", cluster, order="version")


def read_gold_events(spark: SparkSession, gold: str) -> DataFrame:
    return events_table(spark, gold).read().select(*EVENTS.fieldNames())


def promote_events(spark: SparkSession, silver: str, gold: str) -> DataFrame | None:
    """Bring the gold events up to date with the silver batches they have not seen; their current rows, None without new ones."""
    table = events_table(spark, gold)
    log = ingest.read_silver_events(spark, silver).filter(F.col("batch_id") > table.snapshot()[0])
    last = log.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    fresh = latest_by_key(_versioned(log), ["global_event_id"], "version")
    parts = table.merge(fresh, last)
    current = table.read().filter(_span("global_event_id").isin(list(parts)))
    return current.join(fresh.select("global_event_id"), "global_event_id", "left_semi").select(*EVENTS.fieldNames())


# ---- serving ----------------------------------------------------------------------------------------------


def _traffic_items(spark: SparkSession, serving: str) -> KeyedTable:
    schema = serving_traffic(spark.createDataFrame([], TRAFFIC)).schema
    day = lambda: F.coalesce(F.nullif(F.regexp_extract("bucket_sk", r"(\d{4}-\d\d-\d\d)T", 1), F.lit("")), F.lit("none"))
    return KeyedTable(spark, f"{serving}/traffic", schema, ["region_pk", "bucket_sk"], day, cluster=["region_pk", "bucket_sk"])


def _event_items(spark: SparkSession, serving: str) -> KeyedTable:
    schema = serving_events(spark.createDataFrame([], EVENTS)).schema

    def span():
        whole = F.regexp_extract("event_pk", r"#(\d{1,18})$", 1).try_cast("bigint")
        return F.coalesce(F.floor(whole / ID_SPAN).cast("string"), F.lit("other"))

    return KeyedTable(spark, f"{serving}/events", schema, ["event_pk"], span, "ids", ["region_gsi_pk", "event_timestamp"])


def load_serving(traffic: DataFrame | None, events: DataFrame | None, serving: str, batch_id: int) -> dict[str, int]:
    """Upsert serving items; a source that is absent or empty is left out of the result. Only the days and the spans of event numbers
    that the rows belong to are rewritten."""
    loaded = {}
    for name, rows, to_items, table in (
        ("traffic_items", traffic, serving_traffic, _traffic_items),
        ("conflict_event_items", events, serving_events, _event_items),
    ):
        count = 0 if rows is None else sum(table(rows.sparkSession, serving).merge(to_items(rows), batch_id).values())
        if count:
            loaded[name] = count
    return loaded


def read_serving_traffic(spark: SparkSession, serving: str) -> DataFrame:
    return _traffic_items(spark, serving).read()


def read_serving_events(spark: SparkSession, serving: str) -> DataFrame:
    return _event_items(spark, serving).read()


def _note(spark: SparkSession, source: str, lake: str, now: str, batch_id: int) -> None:
    """What a source delivered last, in place of what it noted before."""
    folder = f"{lake}/manifest/source={source}"
    entry = manifest_row(spark, source, None, now, f"{lake}/serving/{source}", "success", {"batch_id": str(batch_id)})
    write_batch(entry, folder, batch_id)
    for name in files.names(spark, folder):
        if name.startswith("batch_id=") and int(name[9:]) < batch_id:
            files.remove(spark, f"{folder}/{name}")


def _serve_scores(spark: SparkSession, gold: str, lake: str, now: str) -> dict[str, int]:
    """Load the scored batches that serving has not seen, then clear their log.

    The load is keyed by the batch number, so a run that dies in between is simply repeated.
    """
    log = read_log(spark, f"{gold}/scored", TRAFFIC).filter(F.col("batch_id") > _traffic_items(spark, f"{lake}/serving").snapshot()[0])
    last = log.agg(F.max("batch_id")).first()[0]
    if last is None:
        return {}
    rows = latest_by_key(log, KEYS, "batch_id").select(*TRAFFIC.fieldNames())
    loaded = load_serving(rows, None, f"{lake}/serving", last)
    _note(spark, "traffic", lake, now, last)
    _clear(spark, f"{gold}/scored", last)
    return loaded


def _clear(spark: SparkSession, log: str, last: int) -> None:
    """Remove the batches of a log up to ``last`` but that one, which a stream that is begun again may repeat."""
    for name in files.names(spark, log):
        if name.startswith("batch_id=") and int(name[9:]) < last:
            files.remove(spark, f"{log}/{name}")


def run_pipeline(
    spark: SparkSession,
    landing: str,
    lake: str,
    now: str,
    bucket_minutes: int = BUCKET_MINUTES,
    max_files: int | None = None,
) -> dict:
    """Drain everything that has arrived, layer by layer; safe to run again at any time.

    ``landing/polls`` holds poll responses and ``landing/exports`` zipped event exports; either
    may be missing, and is then absent from the summary. ``now`` is only noted in the manifest.
    ``max_files`` splits a backlog into micro-batches of that many files. Input that cannot be read is counted as
    ``malformed_polls`` and ``malformed_records`` where there is any.
    """
    summary: dict = {}
    marks, gold = f"{lake}/checkpoints", f"{lake}/gold"
    if files.has_files(spark, f"{landing}/polls"):
        bronze, silver = f"{lake}/bronze/states", f"{lake}/silver/states"
        polls = ingest.drain_observed(ingest.polls_to_bronze(stream_polls(spark, f"{landing}/polls", max_files), bronze, f"{marks}/bronze"))
        records = stream_records(spark, bronze, max_files)
        records = ingest.drain_observed(ingest.records_to_silver(records, silver, f"{marks}/silver"))
        states = ingest.stream_silver_states(spark, silver, max_files)
        counted = ingest.drain(gold_stream.count_buckets(states, silver, gold, f"{marks}/counts", bucket_minutes))
        summary.update(polls=polls.rows, records=records.rows, states=counted)
        summary.update((k, n) for k, n in sorted((polls.observed + records.observed).items()) if n)
        changes = [int(n[9:]) for n in files.names(spark, f"{gold}/changes") if n.startswith("batch_id=")]
        if changes:
            ingest.drain(gold_stream.score_buckets(spark, gold, f"{marks}/scores", max_files))
            _clear(spark, f"{gold}/changes", max(changes))
            summary.update(_serve_scores(spark, gold, lake, now))
    if files.has_files(spark, f"{landing}/exports"):
        silver = f"{lake}/silver/events"
        exports = stream_exports(spark, f"{landing}/exports", max_files)
        summary["export_files"] = ingest.drain(ingest.exports_to_silver(exports, silver, f"{marks}/events"))
        events = promote_events(spark, silver, gold)
        if events is not None:
            last = events_table(spark, gold).snapshot()[0]
            summary.update(load_serving(None, events, f"{lake}/serving", last))
            _note(spark, "events", lake, now, last)
    return summary
