"""The registered queries: every operator over the whole tables of a directory."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions import geo, text, times
from skytally.operators import (
    baseline,
    cleaning,
    correlation,
    dedup,
    events,
    history,
    kpis,
    mapview,
    serving,
    traffic,
)
from skytally.plans import adapters, jobs
from skytally.schemas import COUNTS, EVENTS, RECORD, STATES, TRAFFIC
from skytally.session import configure, work_path
from skytally.sources import exports, polls, quarantine, records, tables
from skytally.sources.keyed import KeyedTable
from skytally.streaming import correlation as stream_correlation
from skytally.streaming import gold, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the checking SQL. The tables cover January 2024.
AS_OF = "2024-01-30 00:00:00"
REPLAY_AT = "2024-01-15 12:00:00"
HOURS = 72
HOUR = 60  # minutes per bucket of the scored series, dense enough to reach every tier
DETAIL_REGION = "OTHER"


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six decimals and times without a zone, so that engines can be compared."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# ---- inputs shared by the queries ---------------------------------------------------------------


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.aggregate_traffic(adapters.near(spark, sf_dir), HOUR)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.score_anomalies(hourly(spark, sf_dir))


def stored_gold(spark: SparkSession, sf_dir: str, root: str | None = None) -> KeyedTable:
    """The scored series as the jobs store it, by month and in a month by region; what the dashboard reads."""
    table = gold.traffic_table(spark, root or work_path(spark, "gold"))
    table.merge(scored(spark, sf_dir), 0)
    return table


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current status of the named airports (the space between them is not on the board)."""
    return history.latest_status(stored_gold(spark, sf_dir).read().filter(F.col("region") != DETAIL_REGION))


def since(hours: int = HOURS) -> Column:
    return times.hours_before(AS_OF, hours)


def as_text(points: str) -> Column:
    """[[x, y], ...] as 'x y, x y'."""
    return F.array_join(F.transform(points, lambda p: F.array_join(F.transform(p, lambda v: v.cast("string")), " ")), ", ")


def numbers(column: str, names: tuple[str, ...] = ("red", "green", "blue", "alpha")) -> list[Column]:
    return [F.get(column, F.lit(i)).alias(name) for i, name in enumerate(names)]


# ---- sources --------------------------------------------------------------------------------------


@query
def flatten_states(spark, sf_dir):
    return adapters.bronze(spark, sf_dir)


RESPONSE_VECTORS = 500  # about so many vectors in a response


def _land_polls(spark, sf_dir, path):
    """Response files as a feed would store them: for each hour as many as its records need, on several lines, and for every tenth hour
    each a second time, cut off."""
    rows = adapters.records(spark, sf_dir).withColumn("poll_timestamp", times.bucket_epoch(F.col("poll_timestamp"), HOUR))
    sizes = rows.groupBy("poll_timestamp").agg(F.ceil(F.count("*") / RESPONSE_VECTORS).alias("responses"))
    dealt = rows.join(sizes, "poll_timestamp").withColumn("response", F.col("event_id") % F.col("responses"))
    polls = adapters.polls_of(dealt, "response").groupBy("time", "response").agg(F.flatten(F.collect_list("states")).alias("states"))
    body = F.to_json(F.struct("time", "states"), {"ignoreNullFields": "false"})
    whole = polls.select("time", F.replace(body, F.lit('"states":'), F.lit('\n"states":\n')).alias("body"))
    cut = whole.filter(F.col("time") / 3600 % 10 == 0).select("time", F.expr("left(body, length(body) - 5)").alias("body"))
    whole.union(cut).select("body").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query
def read_polls(spark, sf_dir):
    """State vectors of stored response files; those that were cut off are left out."""
    return polls.flatten_states(polls.read_polls(spark, _land_polls(spark, sf_dir, work_path(spark, "polls"))))


@query
def scan_polls(spark, sf_dir):
    """The same read piece by piece, as responses of any size can be."""
    return polls.scan_states(spark, _land_polls(spark, sf_dir, work_path(spark, "polls")))


def _with_bad_rows(spark, sf_dir):
    """Records of which some have positions or times that no table holds."""
    n = F.col("event_id") % 50
    lat = F.when(n == 1, F.lit(1e300)).when(n == 2, F.lit(float("inf"))).when(n == 3, F.lit(91.0)).otherwise(F.col("latitude"))
    at = F.when(n == 4, F.lit(10**17)).otherwise(F.col("poll_timestamp"))
    return adapters.records(spark, sf_dir).withColumns({"latitude": lat, "poll_timestamp": at})


@query
def quarantined_records(spark, sf_dir):
    """What is set aside, by reason, next to the rows that go on: cleaned rows and, of those, rows in a bucket."""
    bad = _with_bad_rows(spark, sf_dir)
    cleaned = cleaning.clean_states(bad.select(*RECORD.fieldNames()))
    cut = polls.malformed_polls(spark, _land_polls(spark, sf_dir, work_path(spark, "polls")))
    parts = {
        "malformed": cut,
        "cleaned": cleaned,
        "bucketed": cleaned.filter(times.bucket_start(F.col("poll_timestamp"), HOUR).isNotNull()),
    }
    rows = quarantine.set_aside(bad).select("reason")
    for name, df in parts.items():
        rows = rows.union(df.select(F.lit(name)))
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


@query
def keyed_messages(spark, sf_dir):
    """Records to keyed JSON messages and back."""
    return records.decode(records.encode(adapters.bronze(spark, sf_dir)))


@query
def bronze_records(spark, sf_dir):
    """Records written as dated NDJSON and read back."""
    path = work_path(spark, "bronze")
    records.write_records(adapters.bronze(spark, sf_dir), path, partitions=spark.sparkContext.defaultParallelism)
    return records.read_records(spark, path)


@query
def export_events(spark, sf_dir):
    """Events packed into zip files, one per Arrow batch of lines, unzipped, parsed and cleaned."""
    lines = adapters.export_lines(spark, sf_dir).select("line")
    return cleaning.clean_events(exports.parse_exports(lines.mapInArrow(_zip_batches, "path STRING, content BINARY")))


@query
def stored_exports(spark, sf_dir):
    """Events stored as zip files, found again in their folder, unzipped, parsed and cleaned."""
    path = work_path(spark, "exports")
    exports.write_exports(adapters.export_lines(spark, sf_dir), path, 2_000)
    return cleaning.clean_events(exports.read_exports(spark, path))


def _zip_batches(batches):
    """One small zip per incoming batch (Spark bounds the rows of a batch)."""
    for number, batch in enumerate(batches):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("events.CSV", "\n".join(batch.column("line").to_pylist()))
        yield pa.RecordBatch.from_pydict({"path": [f"{number}.export.CSV.zip"], "content": [body.getvalue()]})


@query
def latest_snapshot(spark, sf_dir):
    """States of the newest poll (polls are hourly here)."""
    polled = adapters.silver(spark, sf_dir).withColumn("poll", times.bucket_start(F.col("poll_timestamp"), HOUR))
    return tables.newest(polled, "poll").select(*STATES.fieldNames())


@query
def newest_file_states(spark, sf_dir):
    """What is shown when there is no live poll: the states of the file written last, of a week stored hour by hour at its end."""
    path = work_path(spark, "bronze")
    polled = adapters.bronze(spark, sf_dir).withColumn("hour", times.bucket_epoch(F.col("poll_timestamp"), HOUR))
    last = polled.agg(F.max("hour")).scalar()
    records.write_records(polled.filter(F.col("hour") < last).drop("hour"), path)
    records.write_records(polled.filter(F.col("hour") == last).drop("hour").coalesce(1), path)
    states, freshness = polls.live_states(spark, f"{path}-live", path)
    return states.withColumn("freshness", F.lit(freshness.split(" ")[0]))


def _history(spark, sf_dir, hours=HOURS):
    """Recent history of one region from the stored gold table: its months, and in these its row groups."""
    table = stored_gold(spark, sf_dir)
    return history.region_history(table.read(first=_month_before(hours)), DETAIL_REGION, AS_OF, hours)


def _month_before(hours: int) -> str:
    return f"{datetime.fromisoformat(AS_OF) - timedelta(hours=hours):%Y-%m}"


@query
def region_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def events_by_region_since(spark, sf_dir):
    return events.events_by_region_since(adapters.conflicts(spark, sf_dir), DETAIL_REGION, since())


@query
def alerts_by_status(spark, sf_dir):
    """From the stored index of alerts, which holds no other rows."""
    root = work_path(spark, "gold")
    months = stored_gold(spark, sf_dir, root).parts()
    gold.index_alerts(spark, root, months, 0)
    return history.alerts_by_status(gold.read_alerts(spark, root), "warning")


def _listing(spark, sf_dir):
    """A file listing with three lines, one per product, for every quarter of an hour with events."""
    slots = (
        adapters.table(spark, sf_dir, "events")
        .select(F.date_format(F.window("ts", "15 minutes").start, "yyyyMMddHHmmss").alias("slot"))
        .distinct()
    )
    products = F.array(*map(F.lit, [".export.CSV.zip", ".mentions.CSV.zip", ".gkg.csv.zip"]))
    return slots.select("slot", F.explode(products).alias("product")).select(
        F.concat(F.lit(" 150  d41d8 http://example.org/v2/"), "slot", "product").alias("value")
    )


@query
def export_urls(spark, sf_dir):
    return exports.export_urls(_listing(spark, sf_dir))


@query
def latest_export_url(spark, sf_dir):
    return exports.latest_export_url(_listing(spark, sf_dir))


@query
def unprocessed_files(spark, sf_dir):
    files = exports.export_urls(_listing(spark, sf_dir))
    manifest = files.filter(F.col("file_name") < "20240120").select("file_name")
    return tables.unprocessed(files, manifest)


def _checkpoints(df, condition):
    """Per operator, the last event of each event type as a map (five shards at most)."""
    last = df.filter(condition).groupBy("source", "event_type").agg(F.max("event_id").cast("string").alias("position"))
    entries = F.collect_list(F.struct("event_type", "position"))
    return last.groupBy("source").agg(F.map_from_entries(entries).alias("checkpoints"))


def _event_sources(spark, sf_dir):
    return adapters.table(spark, sf_dir, "events").withColumn("source", F.concat(F.lit("s"), F.col("user_id") % 50))


@query
def merge_checkpoints(spark, sf_dir):
    rows = _event_sources(spark, sf_dir)
    split = F.lit(REPLAY_AT).cast("timestamp_ntz")
    old = _checkpoints(rows, F.col("ts") < split).withColumnRenamed("checkpoints", "old")
    new = _checkpoints(rows, F.col("ts") >= split).withColumnRenamed("checkpoints", "new")
    merged = old.join(new, "source", "full").select("source", tables.merge_checkpoints(F.col("old"), F.col("new")).alias("m"))
    return merged.select("source", F.explode("m").alias("shard", "position"))


@query
def stored_etag(spark, sf_dir):
    """The last file name each source delivered, by keyed lookup in a manifest log."""
    log = _event_sources(spark, sf_dir).select(
        F.col("source").alias("source_name"),
        F.concat("event_type", F.lit("-"), "event_id").alias("source_etag"),
        F.col("event_id").alias("batch_id"),
    )
    return tables.stored_etag(dedup.latest_by_key(log, ["source_name"], "batch_id"), "s7")


@query
def expired_partitions(spark, sf_dir):
    listing = adapters.table(spark, sf_dir, "events").select(F.to_date("ts").alias("dt"))
    return tables.expired_partitions(listing, AS_OF, 10)


# ---- cleaning ---------------------------------------------------------------------------------------


@query
def clean_states(spark, sf_dir):
    return adapters.silver(spark, sf_dir)


@query
def nearest_region(spark, sf_dir):
    placed = adapters.records(spark, sf_dir).dropna(subset=["latitude", "longitude"])
    return geo.assign_nearest(placed, km_out="km").select("event_id", "nearest_region", F.round("km", 3).alias("km"))


# A lattice of reference points, far more than are written out as expressions.
LATTICE = [
    (f"P{row * 40 + column}", 11.0 + row * 1.1, 30.0 + column * 0.9)
    for row in range(25)
    for column in range(40)
]


@query
def nearest_of_many(spark, sf_dir):
    """Nearest of a thousand reference points, within 30 km."""
    placed = adapters.records(spark, sf_dir).dropna(subset=["latitude", "longitude"])
    found = geo.assign_nearest(placed, out="point", km_out="km", points=LATTICE, max_km=30.0)
    return found.select("event_id", "point", F.round("km", 3).alias("km"))


@query
def haversine(spark, sf_dir):
    """Distance of every position to the first airport."""
    _, lat, lon = mapview.AIRPORTS[0]
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    return adapters.records(spark, sf_dir).select("event_id", km.alias("km"))


@query
def resolve_airline(spark, sf_dir):
    return adapters.records(spark, sf_dir).select("event_id", text.airline_name(F.col("callsign")).alias("airline"))


@query
def zone_for_point(spark, sf_dir):
    return kpis.with_zone(adapters.records(spark, sf_dir)).select("event_id", "zone")


@query
def events_in_bbox(spark, sf_dir):
    raw = adapters.raw_events(spark, sf_dir)
    placed = raw.select(
        F.col("GLOBALEVENTID").alias("global_event_id"),
        F.col("ActionGeo_Lat").try_cast("double").alias("lat"),
        F.col("ActionGeo_Long").try_cast("double").alias("lon"),
    )
    return cleaning.filter_box(placed, "lat", "lon")


@query
def clean_events(spark, sf_dir):
    return adapters.conflicts(spark, sf_dir)


@query
def filter_airlines(spark, sf_dir):
    return kpis.count_by(cleaning.filter_any(adapters.silver(spark, sf_dir), "airline", ["Emirates", "Saudia"]), "airline")


# ---- traffic and scores -------------------------------------------------------------------------------


@query
def traffic_by_bucket(spark, sf_dir):
    return traffic.aggregate_traffic(adapters.near(spark, sf_dir))


@query
def rolling_baseline(spark, sf_dir):
    return baseline.rolling_baseline(hourly(spark, sf_dir))


@query
def anomaly_score(spark, sf_dir):
    return scored(spark, sf_dir)


@query
def anomaly_score_dense(spark, sf_dir):
    """Five-minute series per event type, many times longer than the baseline window."""
    rows = adapters.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("nearest_region"),
        F.concat(F.lit("ac"), "user_id").alias("icao24"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("poll_timestamp"),
    )
    return baseline.score_anomalies(traffic.aggregate_traffic(rows))


@query
def latest_status(spark, sf_dir):
    return history.latest_status(scored(spark, sf_dir))


@query
def status_as_of(spark, sf_dir):
    return history.status_as_of(scored(spark, sf_dir), REPLAY_AT, mapview.airports(spark))


def _stored(df, label, schema):
    """The table a later step reads, written once; its input is then not computed again per use."""
    path = work_path(df.sparkSession, label)
    tables.write_batch(df, path, 0)
    return tables.read_log(df.sparkSession, path, schema).drop("batch_id")


@query
def recent_history(spark, sf_dir):
    """The last 48 hourly buckets of the regions seen on the last day."""
    series = _stored(hourly(spark, sf_dir), "counts", COUNTS)
    return history.recent_history(series, series.filter(F.col("bucket_sk") >= F.lit(AS_OF).cast("timestamp")), 48)


@query
def new_scored_rows(spark, sf_dir):
    rows = _stored(scored(spark, sf_dir), "traffic", TRAFFIC)
    return history.only_keys(rows, rows.filter(F.col("bucket_sk") >= since()))


def _versions(spark, sf_dir):
    """A stored series with outdated counts, and newer counts that overlap it by a day."""
    counts = _stored(hourly(spark, sf_dir), "counts", COUNTS)
    bucket = F.col("bucket_sk")
    outdated = counts.withColumn("aircraft_count", F.col("aircraft_count") + 2)
    return (
        outdated.filter(bucket < F.lit("2024-01-21").cast("timestamp")),
        counts.filter(bucket >= F.lit("2024-01-20").cast("timestamp")),
    )


@query
def merge_history(spark, sf_dir):
    stored, new = _versions(spark, sf_dir)
    return dedup.merge_latest(stored, new, history.KEYS)


@query
def incremental_score(spark, sf_dir):
    stored, new = _versions(spark, sf_dir)
    return history.incremental_score(stored, new)


@query
def upsert_traffic(spark, sf_dir):
    """Two overlapping batches merged into a table by day and read back; the second rewrites its own days only."""
    table = gold.counts_table(spark, work_path(spark, "counts"))
    for batch_id, counts in enumerate(_versions(spark, sf_dir)):
        table.merge(counts, batch_id)
    return table.read()


@query
def upsert_events(spark, sf_dir):
    """Overlapping pulls of events: the later pull replaces what it repeats."""
    table = jobs.events_table(spark, work_path(spark, "gold"))
    pulled = adapters.conflicts(spark, sf_dir)
    repeated = pulled.filter(F.col("quad_class") == 4).withColumn("num_mentions", F.col("num_mentions") + 1000)
    for batch_id, rows in enumerate((pulled, repeated)):
        table.merge(rows.withColumn("version", F.lit(batch_id)), batch_id)
    return table.read().select(*EVENTS.fieldNames())


@query
def drop_event_correlation(spark, sf_dir):
    return correlation.correlate_with_events(scored(spark, sf_dir), adapters.conflicts(spark, sf_dir), 60, HOUR)


@query
def anomaly_event_correlation(spark, sf_dir):
    """Both directions, with a window that is not a multiple of the bucket."""
    anomalies, found = scored(spark, sf_dir), adapters.conflicts(spark, sf_dir)
    return correlation.correlate_with_events(anomalies, found, 150, HOUR, ("drop", "spike"))


# ---- serving ------------------------------------------------------------------------------------------


@query
def serving_traffic(spark, sf_dir):
    items = serving.serving_traffic(tidy(scored(spark, sf_dir)))
    return items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])


@query
def serving_traffic_json(spark, sf_dir):
    """Items as JSON text, read back: the number of attributes present, and their values."""
    items = serving.serving_traffic(tidy(scored(spark, sf_dir)))
    read = F.from_json("item", items.schema)
    back = serving.as_json(items).select(F.size(F.json_object_keys("item")).alias("attributes"), read.alias("i"))
    return back.select("attributes", *[F.col(f"i.{c}").cast("string").alias(c) for c in items.columns])


@query
def serving_events(spark, sf_dir):
    items = serving.serving_events(tidy(adapters.conflicts(spark, sf_dir)))
    return items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])


@query
def decode_history(spark, sf_dir):
    return serving.decode_traffic(serving.serving_traffic(scored(spark, sf_dir)))


@query
def baseline_series(spark, sf_dir):
    return history.baseline_series(_history(spark, sf_dir, 10 * HOURS))


@query
def recent_critical(spark, sf_dir):
    items = serving.recent_critical(serving.serving_traffic(tidy(scored(spark, sf_dir))))
    return items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])


# ---- dashboard ------------------------------------------------------------------------------------------


@query
def count_by_region(spark, sf_dir):
    return kpis.count_by(adapters.silver(spark, sf_dir), "nearest_region")


@query
def count_by_airline(spark, sf_dir):
    return kpis.count_by(adapters.silver(spark, sf_dir), "airline")


@query
def airline_list(spark, sf_dir):
    return kpis.airline_list(adapters.silver(spark, sf_dir))


@query
def kpi_summary(spark, sf_dir):
    return kpis.kpi_summary(adapters.silver(spark, sf_dir))


@query
def top_regions(spark, sf_dir):
    return kpis.top_by_count(adapters.silver(spark, sf_dir), "nearest_region", 5)


@query
def top_airlines(spark, sf_dir):
    return kpis.top_airlines(adapters.silver(spark, sf_dir))


@query
def top_airlines_bar(spark, sf_dir):
    return kpis.top_airlines_bar(adapters.silver(spark, sf_dir))


@query
def ranked_labels(spark, sf_dir):
    return kpis.ranked_labels(adapters.silver(spark, sf_dir), "nearest_region")


@query
def alert_count(spark, sf_dir):
    return kpis.alert_count(current(spark, sf_dir))


@query
def status_counts(spark, sf_dir):
    return kpis.status_counts(current(spark, sf_dir))


@query
def alert_board(spark, sf_dir):
    return kpis.alert_board(current(spark, sf_dir))


@query
def zone_counts(spark, sf_dir):
    return kpis.zone_counts(adapters.silver(spark, sf_dir))


@query
def zone_total(spark, sf_dir):
    return kpis.zone_total(adapters.silver(spark, sf_dir))


@query
def altitude_speed(spark, sf_dir):
    return kpis.altitude_speed(adapters.silver(spark, sf_dir))


@query
def altitude_bands(spark, sf_dir):
    return kpis.altitude_bands(adapters.silver(spark, sf_dir))


@query
def detour_cost(spark, sf_dir):
    return kpis.detour_cost(adapters.silver(spark, sf_dir))


@query
def detour_cost_full(spark, sf_dir):
    return kpis.detour_cost(adapters.silver(spark, sf_dir), use_full_operating_cost=True)


@query
def event_counts(spark, sf_dir):
    return kpis.event_counts(adapters.conflicts(spark, sf_dir), since())


@query
def events_all_regions(spark, sf_dir):
    return events.events_all_regions(adapters.conflicts(spark, sf_dir), since(24))


@query
def recent_events(spark, sf_dir):
    return events.recent_events(adapters.conflicts(spark, sf_dir))


@query
def top_events(spark, sf_dir):
    return events.top_events(events.events_by_region_since(adapters.conflicts(spark, sf_dir), DETAIL_REGION, since()))


@query
def trend_overlay(spark, sf_dir):
    series = _history(spark, sf_dir)
    found = events.events_by_region_since(adapters.conflicts(spark, sf_dir), DETAIL_REGION, since())
    return events.trend_overlay(series, found).select("global_event_id", "marker_size", "marker_colour", "y")


@query
def region_detail(spark, sf_dir):
    return kpis.region_detail(_history(spark, sf_dir))


@query
def map_points(spark, sf_dir):
    points = mapview.map_points(adapters.silver(spark, sf_dir))
    return points.select("icao24", "poll_timestamp", "longitude", "latitude", "angle", *numbers("colour"))


@query
def colour_rgba(spark, sf_dir):
    """Each operator's chart colour as numbers."""
    counted = kpis.count_by(adapters.silver(spark, sf_dir), "airline")
    return counted.select(
        "airline", "aircraft", text.hex_to_rgba(kpis.airline_colour(F.col("airline"))).alias("rgba")
    ).select("airline", "aircraft", *numbers("rgba"))


@query
def zone_polygons(spark, sf_dir):
    rings = mapview.zone_polygons(adapters.silver(spark, sf_dir))
    return rings.select("zone", as_text("polygon").alias("polygon"), "aircraft", *numbers("fill"))


@query
def airport_halos(spark, sf_dir):
    halos = mapview.airport_halos(current(spark, sf_dir))
    return halos.select("region", "latitude", "longitude", "anomaly_status", *numbers("halo"))


@query
def corridors(spark, sf_dir):
    lines = mapview.corridors(adapters.silver(spark, sf_dir))
    return lines.select(
        "icao24", "poll_timestamp", "longitude", "latitude", "nearest_region",
        "target_longitude", "target_latitude", *numbers("colour"),
    )


# ---- jobs and streams -----------------------------------------------------------------------------------


@query
def bronze_to_silver(spark, sf_dir):
    """Both cleaned sources next to each other, counted by region."""
    states, found = jobs.bronze_to_silver(adapters.bronze(spark, sf_dir), adapters.raw_events(spark, sf_dir))
    return kpis.count_by(states, "nearest_region", "states").join(
        kpis.count_by(found, "nearest_region", "events"), "nearest_region", "full"
    )


@query
def silver_to_gold(spark, sf_dir):
    return jobs.silver_to_gold(adapters.silver(spark, sf_dir), HOUR)


@query
def load_serving(spark, sf_dir):
    """The serving load of a gold table, run twice over the same rows, read back as rows."""
    path = work_path(spark, "serving")
    rows = _stored(scored(spark, sf_dir), "traffic", TRAFFIC)
    for batch_id in (0, 1):
        jobs.load_serving(rows, None, path, batch_id)
    return serving.decode_traffic(jobs.read_serving_traffic(spark, path))


@query
def gold_events(spark, sf_dir):
    """Events of two overlapping exports; the later one has every second event again, with its final mentions."""
    path = work_path(spark, "events")
    found = adapters.conflicts(spark, sf_dir)
    early = found.withColumn("num_mentions", F.col("num_mentions") + 1).withColumn("source_file", F.lit("a.zip"))
    late = found.filter(F.col("global_event_id").cast("long") % 2 == 0).withColumn("source_file", F.lit("b.zip"))
    for batch_id, rows in enumerate((early, late)):
        tables.write_batch(rows, path, batch_id)
    return jobs.current_events(ingest.read_silver_events(spark, path))


@query
def pipeline_summary(spark, sf_dir):
    """Rows per layer of two runs in a row over stored responses and no exports, and what the manifest notes."""
    root = work_path(spark, "pipeline")
    _land_polls(spark, sf_dir, f"{root}/landing/polls")
    runs = [jobs.run_pipeline(spark, f"{root}/landing", f"{root}/lake", AS_OF, HOUR) for _ in range(2)]
    rows = [(i, layer, int(n)) for i, summary in enumerate(runs) for layer, n in summary.items()]
    counted = spark.createDataFrame(rows, "run INT, layer STRING, n BIGINT")
    known = tables.read_manifest(spark, f"{root}/lake/manifest").filter("last_run_status = 'success'")
    return counted.union(known.select(F.lit(1), F.concat(F.lit("manifest "), "source_name"), F.lit(1).cast("bigint")))


def _event_stream(spark, sf_dir):
    """The events table as a stream of its files. The pattern matches a file as well as a folder."""
    schema = adapters.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _silver_stream(rows, root):
    """Drain a stream of records into a silver table of cleaned states."""
    ingest.drain(ingest.records_to_silver(rows, f"{root}/silver", f"{root}/marks/silver"))
    return f"{root}/silver"


def _record_stream(spark, sf_dir):
    return adapters.records_of(_event_stream(spark, sf_dir)).select(*RECORD.fieldNames())


@query
def stream_clean_states(spark, sf_dir):
    silver = _silver_stream(adapters.bronze_of(_record_stream(spark, sf_dir)), work_path(spark, "stream"))
    return ingest.read_silver_states(spark, silver).select(*STATES.fieldNames())


@query
def stream_traffic_by_bucket(spark, sf_dir):
    root = work_path(spark, "stream")
    silver = _silver_stream(_record_stream(spark, sf_dir), root)
    counts = gold.windowed_traffic(ingest.stream_silver_states(spark, silver), "60 days")
    ingest.drain(gold.upsert_counts(counts, f"{root}/counts", f"{root}/marks/counts"))
    return tables.read_current(spark, f"{root}/counts", COUNTS, history.KEYS)


@query
def stream_anomaly_score(spark, sf_dir):
    root = work_path(spark, "stream")
    silver = _silver_stream(_record_stream(spark, sf_dir), root)
    states = ingest.stream_silver_states(spark, silver)
    ingest.drain(gold.count_buckets(states, silver, f"{root}/gold", f"{root}/marks/counts", HOUR))
    ingest.drain(gold.score_buckets(spark, f"{root}/gold", f"{root}/marks/scores"))
    return gold.read_traffic(spark, f"{root}/gold")


def _late_silver(spark, sf_dir, root):
    """Silver files of which the second half is late: every seventh row comes after all others; how many files make six micro-batches."""
    events, silver = adapters.table(spark, sf_dir, "events"), f"{root}/silver"
    for number, part in enumerate((events.filter("event_id % 7 != 0"), events.filter("event_id % 7 = 0"))):
        part.write.parquet(f"{root}/arrived/part={number}")
        arrived = spark.readStream.schema(events.schema).parquet(f"{root}/arrived")
        rows = adapters.records_of(arrived).select(*RECORD.fieldNames())
        ingest.drain(ingest.records_to_silver(rows, silver, f"{root}/marks/silver"))
    return silver, max(1, len(ingest.read_silver_states(spark, silver).inputFiles()) // 6)


@query
def stream_late_scores(spark, sf_dir):
    """The scored series after six micro-batches, the last ones with rows for every day before."""
    root = work_path(spark, "stream")
    silver, max_files = _late_silver(spark, sf_dir, root)
    states = ingest.stream_silver_states(spark, silver, max_files)
    ingest.drain(gold.count_buckets(states, silver, f"{root}/gold", f"{root}/marks/counts", HOUR))
    changes = len(gold.read_changes(spark, f"{root}/gold").inputFiles())
    ingest.drain(gold.score_buckets(spark, f"{root}/gold", f"{root}/marks/scores", max(1, changes // 6)))
    return gold.read_traffic(spark, f"{root}/gold")


@query
def stream_late_traffic(spark, sf_dir):
    """Windowed counts that refuse rows a day late, with what they refused counted again."""
    root = work_path(spark, "stream")
    silver, max_files = _late_silver(spark, sf_dir, root)
    counts = gold.windowed_traffic(ingest.stream_silver_states(spark, silver, max_files), "24 hours")
    ingest.drain(gold.upsert_counts(counts, f"{root}/counts", f"{root}/marks/counts"))
    side = gold.late_buckets(ingest.stream_silver_states(spark, silver, max_files), f"{root}/side", f"{root}/marks/side", 24)
    ingest.drain(side)
    kept = tables.read_current(spark, f"{root}/counts", COUNTS, history.KEYS)
    return gold.recounted(spark, kept, f"{root}/side", silver)


@query
def stream_event_correlation(spark, sf_dir):
    """Drops and events matched as two streams, then folded per drop."""
    root = work_path(spark, "stream")
    scored(spark, sf_dir).filter("anomaly_direction = 'drop'").write.parquet(f"{root}/drops")
    adapters.conflicts(spark, sf_dir).write.parquet(f"{root}/events")
    drops = spark.readStream.schema(TRAFFIC).parquet(f"{root}/drops")
    found = spark.readStream.schema(EVENTS).parquet(f"{root}/events")
    pairs = stream_correlation.match_events(drops, found, 60, "60 days")
    ingest.drain(stream_correlation.store_pairs(pairs, f"{root}/pairs", f"{root}/marks"))
    return stream_correlation.correlated(spark, spark.read.schema(TRAFFIC).parquet(f"{root}/drops"), f"{root}/pairs")
