import json
import random
import time

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from skytally.operators import baseline, history, traffic
from skytally.operators.cleaning import clean_states
from skytally.plans import jobs
from skytally.schemas import RECORD, TRAFFIC
from skytally.sources import records, tables
from skytally.streaming import gold, ingest
from test_sources import line, vector, write_poll, write_zip

START = 1767225600  # 2026-01-01


class Lake:
    """Bronze records arriving file by file, drained into silver and gold."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.bronze, self.silver, self.gold = (str(root / layer) for layer in ("bronze", "silver", "gold"))
        self.score_anomalies = baseline.score_anomalies
        self.rows = []

    def arrive(self, name, rows):
        """(aircraft, lat, lon, epoch) rows as one new file."""
        folder = self.root / "bronze" / "dt=2026-01-01"
        folder.mkdir(parents=True, exist_ok=True)
        keys = ("icao24", "latitude", "longitude", "poll_timestamp")
        (folder / f"{name}.ndjson").write_text("\n".join(json.dumps(dict(zip(keys, r))) for r in rows))
        self.rows += rows

    def drain(self, max_files=1, horizon_hours=gold.HORIZON_HOURS):
        stream = records.stream_records(self.spark, self.bronze, max_files)
        silver_rows = ingest.drain(ingest.records_to_silver(stream, self.silver, str(self.root / "m1")))
        states = ingest.stream_silver_states(self.spark, self.silver, max_files)
        counted = gold.count_buckets(states, self.silver, self.gold, str(self.root / "m2"), horizon_hours=horizon_hours)
        gold_rows = ingest.drain(counted)
        self.score()
        return silver_rows, gold_rows

    def score(self):
        ingest.drain(gold.score_buckets(self.spark, self.gold, str(self.root / "m3")))

    def expected(self):
        schema = "icao24 STRING, latitude DOUBLE, longitude DOUBLE, poll_timestamp BIGINT"
        df = self.spark.createDataFrame(self.rows, schema)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD.fields if f.name not in df.columns]
        states = clean_states(df.select("*", *missing).select(*RECORD.fieldNames()))
        return self.score_anomalies(traffic.aggregate_traffic(states))

    def check(self):
        def rounded(df):
            return rows_of(df.select("region", "bucket_sk", "aircraft_count", "baseline_n", F.round("z_score", 9), "anomaly_status", "anomaly_direction"))

        assert rounded(gold.read_traffic(self.spark, self.gold).select(*TRAFFIC.fieldNames())) == rounded(self.expected())


DXB, DOH, SEA = (25.25, 55.36), (25.27, 51.61), (15.0, 55.0)


def sightings(minutes, aircraft, places=(DXB, DOH, SEA)):
    return [(f"a{n}", *place, START + 60 * m) for m in minutes for place in places for n in range(aircraft(m))]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_gold_follows_batches_late_rows_and_replays(spark, lake):
    busy = lambda m: 3 + m % 7
    lake.arrive("a", sightings(range(0, 100, 5), busy))
    lake.arrive("b", sightings(range(100, 160, 5), busy) + [("lost", None, None, START)])
    assert lake.drain()[0] == len(lake.rows)
    lake.check()
    assert lake.drain() == (0, 0)  # nothing new
    lake.check()
    # Two files for one bucket: its count is the union, not the last file.
    lake.arrive("c", [("x1", *DXB, START + 9700), ("x2", *DXB, START + 9700)])
    lake.arrive("d", [("x2", *DXB, START + 9710), ("x3", *DXB, START + 9800)])
    lake.drain()
    lake.check()
    # Very late rows, in front of everything and in the middle, move the later scores.
    lake.arrive("e", sightings([-30, 41], lambda m: 40, [DXB]))
    lake.drain()
    lake.check()
    # Replaying a batch by hand leaves the same table.
    silver = ingest.read_silver_states(spark, lake.silver)
    last = max(int(p.name.split("=")[1]) for p in (lake.root / "gold" / "changes").iterdir() if "=" in p.name)
    for batch_id in (last, last + 1, last + 1):
        gold.count_batch(spark, silver.filter(F.col("icao24").startswith("x")), batch_id, lake.silver, lake.gold)
    lake.score()
    lake.check()


def test_rows_behind_the_horizon_are_counted_from_silver(spark, lake):
    """Sightings are kept for an hour; the first file spans many, the last comes a day late."""
    lake.arrive("a", sightings(range(0, 600, 5), lambda m: 3 + m % 7))
    lake.arrive("b", sightings(range(600, 630, 5), lambda m: 4))
    lake.drain(horizon_hours=1)
    lake.check()
    assert len(gold.sightings_table(spark, lake.gold).parts()) <= 3
    lake.arrive("c", [("late", *DXB, START + 60 * 7), ("a0", *DXB, START + 60 * 7), ("early", *SEA, START - 3600)])
    lake.drain(horizon_hours=1)
    lake.check()


def test_work_of_a_batch_does_not_grow(spark, lake):
    """Folders and state after many batches are those of the last hours and of the days, not of the batches."""
    lake.arrive("a", sightings(range(0, 60, 5), lambda m: 3))
    lake.drain()
    silver = ingest.read_silver_states(spark, lake.silver)
    folders, versions = [], []
    for batch_id in range(1, 13):
        moved = silver.withColumn("poll_timestamp", F.col("poll_timestamp") + batch_id * 1800)
        gold.count_batch(spark, moved, batch_id, lake.silver, lake.gold, horizon_hours=2)
        folders.append(sum(1 for p in (lake.root / "gold" / "sightings" / "data").rglob("v=*")))
        versions.append(sum(1 for p in (lake.root / "gold" / "sightings" / "versions").glob("*.json")))
    assert max(folders[6:]) <= max(folders[4:7]) and max(versions) <= 2
    assert len(gold.sightings_table(spark, lake.gold).parts()) <= 4


class Handle:
    """State of one key in memory."""

    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_ring_asks_for_what_it_does_not_hold():
    """Against the whole series: what a batch changes is either scored with complete baselines or named as late."""
    rng = random.Random(3)
    for size in (3, 10):
        ring, handle, series = gold.Ring(size), Handle(), {}
        ring.init(handle)
        for step in range(60):
            batch = {}
            for _ in range(rng.randint(1, 4)):
                at = max(0, step * 2 - (rng.randint(0, 60) if rng.random() < 0.3 else rng.randint(0, 3)))
                batch[at] = series.get(at, 0) + rng.randint(0, 2)
            changed = {at for at, n in batch.items() if n > series.get(at, -1)}
            series.update({at: batch[at] for at in changed})
            frame = pd.DataFrame({"at": list(batch), "aircraft_count": list(batch.values())})
            (out,) = ring.handleInputRows(("R",), iter([frame]), None)
            rows = list(out.itertuples(index=False))
            order = sorted(series)
            late = {r.at for r in rows if r.late}
            inside = [r for r in rows if not r.late]
            assert all(series[r.at] == r.aircraft_count for r in rows) and late <= set(batch)
            moved = set()
            for at in changed | late:  # whether a count is new is not known behind the ring
                moved.update(order[order.index(at) : order.index(at) + size + 1])
            shown = [r.at for r in inside]
            assert shown == sorted(set(shown))
            for r in inside:
                if r.affected:
                    before = order[max(0, order.index(r.at) - size) : order.index(r.at)]
                    place = shown.index(r.at)
                    assert shown[max(0, place - size) : place] == before
            covered = {r.at for r in inside if r.affected}
            for at in late:
                covered.update(order[order.index(at) : order.index(at) + size + 1])
            assert covered == moved
            assert len(handle.value[1]) <= 2 * size


def test_changes_behind_the_ring_are_scored_from_the_table(spark, lake, monkeypatch):
    ring = gold.Ring(15)
    monkeypatch.setattr(gold, "Ring", lambda: ring)
    monkeypatch.setattr(gold, "score_anomalies", lambda df: baseline.score_anomalies(df, 15))
    monkeypatch.setattr(gold, "rescore", lambda counts, changed: history.rescore(counts, changed, 15))
    lake.score_anomalies = lambda df: baseline.score_anomalies(df, 15)
    lake.arrive("a", sightings(range(0, 300, 5), lambda m: 3 + m % 7, [DXB, SEA]))
    lake.drain()
    lake.arrive("b", sightings([2, 150, 299], lambda m: 30, [DXB]) + sightings([305], lambda m: 2, [SEA]))
    lake.drain()
    lake.check()


def test_a_bucket_without_rows_never_appears(spark, lake):
    lake.arrive("a", sightings([0, 5, 60], lambda m: 2, [DXB]))
    lake.drain()
    assert gold.read_traffic(spark, lake.gold).count() == 3


def test_windowed_counts(spark, lake):
    lake.arrive("a", sightings(range(0, 60, 2), lambda m: 4))
    lake.arrive("b", sightings(range(30, 90, 2), lambda m: 6))
    stream = records.stream_records(spark, lake.bronze, 1)
    ingest.drain(ingest.records_to_silver(stream, lake.silver, str(lake.root / "m1")))
    counts = gold.windowed_traffic(ingest.stream_silver_states(spark, lake.silver, 1), "2 hours")
    path = str(lake.root / "counts")
    ingest.drain(gold.upsert_counts(counts, path, str(lake.root / "m3")))
    got = tables.read_current(spark, path, gold.COUNTS, gold.KEYS)
    assert rows_of(got) == rows_of(lake.expected().select(*got.columns))


def test_what_the_watermark_refuses_is_counted_again(spark, lake):
    lake.arrive("a", sightings(range(0, 60, 5), lambda m: 3))
    lake.arrive("b", sightings(range(400, 460, 5), lambda m: 4))
    lake.arrive("c", sightings(range(2, 42, 5), lambda m: 6, [DXB]) + [("first", *SEA, START - 900)])
    lake.arrive("d", sightings(range(440, 480, 5), lambda m: 5) + [("again", *DXB, START)])
    stream = records.stream_records(spark, lake.bronze, 1)
    ingest.drain(ingest.records_to_silver(stream, lake.silver, str(lake.root / "m1")))
    path = str(lake.root / "counts")
    for max_files in (1, 2):  # the side output may cut its batches in another way
        counts = gold.windowed_traffic(ingest.stream_silver_states(spark, lake.silver, 1), "30 minutes")
        ingest.drain(gold.upsert_counts(counts, f"{path}{max_files}", str(lake.root / f"m3{max_files}")))
        states = ingest.stream_silver_states(spark, lake.silver, max_files)
        ingest.drain(gold.late_buckets(states, f"{path}{max_files}-side", str(lake.root / f"m4{max_files}"), 0.5))
        kept = tables.read_current(spark, f"{path}{max_files}", gold.COUNTS, gold.KEYS)
        expected = rows_of(lake.expected().select(*kept.columns))
        assert rows_of(kept) != expected  # some rows were refused
        assert rows_of(gold.recounted(spark, kept, f"{path}{max_files}-side", lake.silver), *kept.columns) == expected


def test_windowed_state_is_bounded(spark, lake):
    """The watermark evicts what can no longer change, and drops what comes later than allowed."""
    for number in range(6):
        lake.arrive(f"f{number}", sightings([number * 60], lambda m: 5, [DXB]))
    stream = records.stream_records(spark, lake.bronze, 1)
    ingest.drain(ingest.records_to_silver(stream, lake.silver, str(lake.root / "m1")))
    counts = gold.windowed_traffic(ingest.stream_silver_states(spark, lake.silver, 1), "10 minutes")
    writer = gold.upsert_counts(counts, str(lake.root / "counts"), str(lake.root / "m3"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    held = [max(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 10  # at most two polls of five aircraft, not all six


def test_pipeline(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    assert jobs.run_pipeline(spark, str(landing), lake, "2026-01-01 00:00:00") == {}
    for i in range(15):
        planes = [vector(_0=f"p{n}") for n in range(10 if i < 14 else 0)] + [vector(_0="q", _6=None)]
        write_poll(landing / "polls" / f"{i:02}.json", START + 300 * i, planes)
    first = jobs.run_pipeline(spark, str(landing), lake, "2026-01-01 01:00:00")
    assert first == {"polls": 15, "records": 155, "states": 140, "traffic_items": 14}
    again = jobs.run_pipeline(spark, str(landing), lake, "2026-01-01 01:05:00")
    assert again == {"polls": 0, "records": 0, "states": 0}

    write_poll(landing / "polls" / "99.json", START + 300 * 14, [vector(_0="p0")])
    write_zip(landing / "exports" / "20260101010000.export.CSV.zip", [line(), line(GLOBALEVENTID="2")])
    write_zip(landing / "exports" / "20260101011500.export.CSV.zip", [line(NumMentions="77")])
    second = jobs.run_pipeline(spark, str(landing), lake, "2026-01-01 01:10:00")
    assert second == {"polls": 1, "records": 1, "states": 1, "traffic_items": 1, "export_files": 2, "conflict_event_items": 2}
    items = jobs.read_serving_traffic(spark, f"{lake}/serving").orderBy(F.desc("bucket_sk"))
    assert items.count() == 15
    newest = items.first()
    assert (newest.anomaly_status, newest.anomaly_direction, newest.status_gsi_pk) == ("critical", "drop", "STATUS#critical")
    events = {r.event_pk: int(r.num_mentions) for r in jobs.read_serving_events(spark, f"{lake}/serving").collect()}
    assert events == {"EVENT#1": 77, "EVENT#2": 10}  # the later export replaced event 1
    promoted = jobs.current_events(ingest.read_silver_events(spark, f"{lake}/silver/events"))
    assert rows_of(promoted, "global_event_id", "num_mentions", "nearest_region") == [("1", 77.0, "RUH"), ("2", 10.0, "RUH")]
    manifest = {r.source_name for r in tables.read_manifest(spark, f"{lake}/manifest").collect()}
    assert manifest == {"traffic", "events"}


def test_many_runs_leave_few_folders(spark, tmp_path):
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    for i in range(14):
        write_poll(landing / "polls" / f"{i:02}.json", START + 300 * i, [vector(_0=f"p{n}") for n in range(10)])
    jobs.run_pipeline(spark, str(landing), str(lake), "2026-01-01 01:00:00", max_files=5)
    write_poll(landing / "polls" / "98.json", START + 300 * 13, [vector(_0="p99")])
    (landing / "polls" / "cut.json").write_text('{"time": 1, "states": [["a')
    jobs.run_pipeline(spark, str(landing), str(lake), "2026-01-01 01:05:00")
    write_poll(landing / "polls" / "99.json", START + 300 * 14, [vector(_0="p0")])
    summary = jobs.run_pipeline(spark, str(landing), str(lake), "2026-01-01 01:10:00")
    assert summary == {"polls": 1, "records": 1, "states": 1, "traffic_items": 1}
    newest = gold.read_traffic(spark, str(lake / "gold")).orderBy(F.desc("bucket_sk")).first()
    assert (newest.baseline_n, newest.anomaly_status, newest.anomaly_direction) == (14, "critical", "drop")
    assert [r.anomaly_status for r in gold.read_alerts(spark, str(lake / "gold")).collect()] == ["critical"]
    for log in ("gold/changes", "gold/scored", "manifest/source=traffic"):
        assert len([p for p in (lake / log).iterdir() if p.name.startswith("batch_id=")]) == 1
    for table in ("gold/traffic", "gold/alerts", "serving/traffic"):
        assert len(list((lake / table / "data").rglob("v=*"))) <= 2


def test_malformed_polls_are_counted(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    write_poll(landing / "polls" / "a.json", START, [vector()])
    (landing / "polls" / "b.json").write_text('{"time": 1,\n "states": [["a"')
    summary = jobs.run_pipeline(spark, str(landing), lake, "2026-01-01 01:00:00")
    assert summary == {"polls": 2, "records": 1, "states": 1, "malformed_polls": 1, "traffic_items": 1}


def test_drain_counts_every_micro_batch(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.txt").write_text("a\nb\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path))
        writer = stream.writeStream.foreachBatch(lambda df, i: time.sleep(1.2 if df.count() else 0))
        assert ingest.drain(writer.option("checkpointLocation", str(tmp_path / "m"))) == 12
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_filters_reach_the_stored_table(spark, tmp_path, series):
    gold.traffic_table(spark, str(tmp_path)).merge(baseline.score_anomalies(series(("DXB", [1, 2, 3]))), 0)
    found = history.region_history(gold.read_traffic(spark, str(tmp_path)), "DXB", "2026-01-01 01:00:00", 24)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(region,DXB)" in plan and "GreaterThanOrEqual(bucket_sk" in plan


def test_serving_load_twice_is_idempotent(spark, tmp_path, series):
    scored = baseline.score_anomalies(series(("DXB", [1, 2, 3])))
    for batch in (0, 1):
        assert jobs.load_serving(scored, None, str(tmp_path), batch) == {"traffic_items": 3}
    assert jobs.load_serving(scored.limit(0), None, str(tmp_path), 2) == {}
    assert jobs.read_serving_traffic(spark, str(tmp_path)).count() == 3


def test_retention_lists_old_bronze(spark, tmp_path):
    for day in ("2026-01-01", "2026-02-20"):
        (tmp_path / f"dt={day}").mkdir()
        (tmp_path / f"dt={day}" / "x.ndjson").write_text("{}")
    listing = tables.list_files(spark, str(tmp_path))
    assert [str(r.dt) for r in tables.expired_partitions(listing, "2026-03-01", 30).collect()] == ["2026-01-01"]


def test_late_rows_for_many_days_write_few_files(spark, lake):
    """Four files with rows for each of 40 days, read as one micro-batch: a file a day in silver, a file a month in the scored series."""
    for k in range(4):
        lake.arrive(f"f{k}", [(f"a{k}", *DXB, START + 86400 * day + k) for day in range(40)])
    lake.drain(max_files=4)
    lake.check()
    assert len(ingest.read_silver_states(spark, lake.silver).inputFiles()) == 40
    days = {r.bucket_sk.date() for r in gold.read_traffic(spark, lake.gold).collect()}
    months = {f"{day:%Y-%m}" for day in days}
    assert len(days) == 40 and len(gold.read_traffic(spark, lake.gold).inputFiles()) == len(months) == len(gold.traffic_table(spark, lake.gold).parts())
