import random

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F
from skytally.operators import baseline, history, traffic
from skytally.operators.correlation import correlate_with_events
from skytally.operators.dedup import latest_by_key, merge_latest
from skytally.schemas import COUNTS, STATES, TRAFFIC


def last(df, region="KWI"):
    return baseline.score_anomalies(df).filter(F.col("region") == region).orderBy(F.desc("bucket_sk")).first()


def test_too_little_history(series):
    """Eleven buckets behind a bucket are too few, twelve are enough."""
    rows = baseline.score_anomalies(series(("KWI", list(range(3, 16))))).orderBy("bucket_sk").collect()
    assert [r.baseline_n for r in rows] == list(range(13))
    assert [r.rolling_mean for r in rows[:12]] == [None] * 12 and rows[12].rolling_mean == sum(range(3, 15)) / 12
    assert {r.anomaly_status for r in rows[:12]} == {"insufficient_baseline"} and {r.z_score for r in rows[:12]} == {None}


@pytest.mark.parametrize(
    "counts, status, direction",
    [
        ([24, 26] * 9 + [3], "critical", "drop"),
        ([24, 26] * 9 + [31], "critical", "spike"),
        ([24, 26] * 9 + [28], "serious", "spike"),
        ([24, 26] * 9 + [25], "normal", None),
        ([7] * 15 + [8], "normal", None),  # the deviation floor keeps a small step harmless
    ],
)
def test_last_bucket(series, counts, status, direction):
    row = last(series(("KWI", counts)))
    assert (row.anomaly_status, row.anomaly_direction) == (status, direction)


def test_regions_are_independent(series):
    df = series(("MCT", [24, 26] * 9 + [3]), ("BAH", [3] * 19))
    assert last(df, "MCT").anomaly_status == "critical"
    assert last(df, "BAH").anomaly_status == "normal"


def test_empty_input_keeps_the_schema(spark):
    out = baseline.score_anomalies(spark.createDataFrame([], COUNTS))
    assert out.columns == TRAFFIC.fieldNames() and out.count() == 0
    empty = traffic.aggregate_traffic(spark.createDataFrame([], STATES))
    assert empty.columns == ["region", "bucket_sk", "aircraft_count"] and empty.count() == 0


def _long_series(length, seed=3):
    rng = random.Random(seed)
    return [rng.randint(0, 60) for _ in range(length)]


def test_long_series_equals_pandas(series):
    counts = _long_series(700)
    got = baseline.score_anomalies(series(("DXB", counts))).orderBy("bucket_sk").toPandas()
    preceding = pd.Series(counts, dtype=float).shift(1).rolling(288, min_periods=12)
    pd.testing.assert_series_equal(got["rolling_mean"], preceding.mean(), check_names=False)
    pd.testing.assert_series_equal(got["rolling_std"], preceding.std(), check_names=False)
    assert list(got["baseline_n"]) == [min(i, 288) for i in range(700)]


@pytest.mark.parametrize("block_rows", [1, 300, 1000])
def test_blocks_equal_one_window(spark, series, block_rows):
    """Sparse series over many weeks, cut into blocks, against a single window per region."""
    rng = random.Random(11)
    rows = [(r, 1767225600 + 300 * t, rng.randint(0, 9)) for r in "AB" for t in sorted(rng.sample(range(40000), 900))]
    df = spark.createDataFrame(rows, "region STRING, at BIGINT, aircraft_count BIGINT")
    df = df.selectExpr("region", "timestamp_seconds(at) AS bucket_sk", "aircraft_count")
    w = Window.partitionBy("region").orderBy("bucket_sk").rowsBetween(-288, -1)
    plain = df.select(
        "region", "bucket_sk", "aircraft_count", F.count("*").over(w).alias("n"), F.round(F.avg("aircraft_count").over(w), 9).alias("m")
    )
    blocked = baseline.rolling_baseline(df, min_buckets=1, block_rows=block_rows).select(
        "region", "bucket_sk", "aircraft_count", F.col("baseline_n").alias("n"), F.round("rolling_mean", 9).alias("m")
    )
    assert rows_of(blocked) == rows_of(plain)


def test_distinct_aircraft_per_bucket(spark):
    base = 1_699_999_800
    rows = [("a", "DXB", base), ("b", "DXB", base + 10), ("a", "DXB", base + 20), (None, "DXB", base), ("c", "DOH", base),
            ("c", "DXB", base + 360), (None, "RUH", base), ("d", None, base), ("d", "DXB", None)]
    out = traffic.aggregate_traffic(spark.createDataFrame(rows, "icao24 STRING, nearest_region STRING, poll_timestamp BIGINT"))
    got = rows_of(out.select("region", F.col("bucket_sk").cast("bigint"), "aircraft_count"))
    assert got == [("DOH", base, 1), ("DXB", base, 2), ("DXB", base + 300, 1), ("RUH", base, 0)]


def test_keep_last_is_deterministic(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", 1, None), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "k STRING, v INT, x STRING")
    assert rows_of(latest_by_key(df, ["k"], ["v"])) == rows_of(spark.createDataFrame([("k", 2, "c"), ("l", 1, None), (None, 5, "n")], df.schema))


def test_new_replaces_history(series):
    merged = merge_latest(series(("DXB", [1, 2, 3])), series(("DXB", [1, 9])), history.KEYS)
    assert [r.aircraft_count for r in merged.orderBy("bucket_sk").collect()] == [1, 9, 3]


def _hit(df, low, high):
    """Buckets low..high of a series."""
    at = (F.unix_seconds("bucket_sk") - 1767225600) / 300
    return df.filter(at.between(low, high))


@pytest.mark.parametrize("low, high", [(690, 699), (650, 660), (0, 3), (100, 699)])
def test_incremental_equals_full(series, low, high):
    """New rows at the end, in the middle and at the start, replacing what was stored."""
    full = series(("DXB", _long_series(700)), ("DOH", _long_series(40, 5)))
    stale = full.withColumn("aircraft_count", F.when(F.lit(True), F.col("aircraft_count") + 7))
    new = _hit(full, low, high)
    stored = merge_latest(full, _hit(stale, low, high), history.KEYS)
    expected = history.only_keys(baseline.score_anomalies(full), new)
    rounded = lambda df: rows_of(df.select("region", "bucket_sk", "baseline_n", F.round("z_score", 9), "anomaly_status"))
    assert rounded(history.incremental_score(stored, new)) == rounded(expected)


def test_rescore_covers_all_affected_rows(series):
    """Changing one old bucket changes the next 288 scores and no others."""
    before = series(("DXB", _long_series(700)))
    changed = _hit(before, 100, 100)
    after = merge_latest(before, changed.withColumn("aircraft_count", F.lit(500).cast("bigint")), history.KEYS)
    got = history.rescore(after, changed)
    assert got.count() == 289
    old, new = baseline.score_anomalies(before), baseline.score_anomalies(after)
    assert rows_of(got) == rows_of(history.only_keys(new, got))
    outside = ["left_anti"]
    for a, b in zip(rows_of(old.join(got, history.KEYS, *outside)), rows_of(new.join(got, history.KEYS, *outside))):
        assert a == b


def test_changes_far_apart_do_not_bring_in_what_lies_between(series):
    before = series(("KWI", _long_series(5000)))
    changed = _hit(before, 40, 40).union(_hit(before, 4990, 4990))
    after = merge_latest(before, changed.withColumn("aircraft_count", F.lit(500).cast("bigint")), history.KEYS)
    got = history.rescore(after, changed)
    assert got.count() == 289 + 10
    assert rows_of(got) == rows_of(history.only_keys(baseline.score_anomalies(after), got))


def test_recent_history_of_a_long_series(series):
    df = series(("A", _long_series(5000)), ("B", _long_series(30, 4)))
    got = history.recent_history(df, None, 288)
    assert [r.aircraft_count for r in got.filter("region = 'A'").collect()] == _long_series(5000)[-288:]
    assert got.filter("region = 'B'").count() == 30


def test_recent_history_reads_back_oldest_first(series):
    df = series(("A", [40, 42, 45]), ("B", [1]))
    regions = df.filter("region = 'A'").select("region")
    assert [r.aircraft_count for r in history.recent_history(df, regions).collect()] == [40, 42, 45]
    assert [r.aircraft_count for r in history.recent_history(df, regions, 2).collect()] == [42, 45]


def test_status_as_of_lists_every_region(spark, series):
    scored = baseline.score_anomalies(series(("DXB", [10] * 20 + [0])))
    regions = spark.createDataFrame([("DXB",), ("DOH",)], "region STRING")
    at = lambda moment: dict(rows_of(history.status_as_of(scored, moment, regions)))
    assert at("2026-01-01 01:40:00") == {"DXB": "critical", "DOH": "insufficient_baseline"}
    assert at("2026-01-01 01:39:59") == {"DXB": "normal", "DOH": "insufficient_baseline"}
    assert at("2025-12-31 00:00:00") == {"DXB": "insufficient_baseline", "DOH": "insufficient_baseline"}


def test_missing_status_gets_the_default(spark):
    rows = spark.createDataFrame([("A", 1, "normal"), ("A", 2, None)], "region STRING, bucket_sk INT, anomaly_status STRING")
    assert history.latest_status(rows).first().anomaly_status == "insufficient_baseline"


@pytest.mark.parametrize("window_minutes", [5, 7, 60])
def test_correlation_against_brute_force(spark, series, window_minutes):
    """Events at random moments, one region with a burst, and events exactly on the window ends."""
    rng = random.Random(5)
    scored = baseline.score_anomalies(series(("A", ([10] * 20 + [0]) * 8), ("B", [10] * 20 + [0, 0])))
    moments = {(r.region, int(r.bucket_sk.timestamp())) for r in scored.filter("anomaly_direction = 'drop'").collect()}
    start, end = min(m for _, m in moments) - 9000, max(m for _, m in moments) + 9000
    found = [(str(i), rng.choice("ABC"), rng.uniform(start, end), rng.choice([None, 1.0, 3.0, 8.0]), rng.uniform(-10, 10)) for i in range(400)]
    burst = min(moments)
    found += [(f"x{i}", burst[0], float(burst[1]), 2.0, -1.0) for i in range(200)]
    found += [(f"e{sign}", region, moment + sign * window_minutes * 60.0, 50.0, 0.0) for region, moment in moments for sign in (-1, 1)]
    events = spark.createDataFrame(found, "global_event_id STRING, nearest_region STRING, t DOUBLE, num_mentions DOUBLE, goldstein_scale DOUBLE")
    events = events.withColumn("event_timestamp", F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint")))
    got = {(r.region, int(r.bucket_sk.timestamp())): r for r in correlate_with_events(scored, events, window_minutes).collect()}
    assert set(got) == moments
    for (region, moment), row in got.items():
        inside = [e for e in found if e[1] == region and abs(e[2] - moment) <= window_minutes * 60]
        assert row.event_count == len(inside)
        assert row.event_mentions == sum(e[3] or 1.0 for e in inside)
        assert row.top_event_id == max(inside, key=lambda e: (e[3] or 1.0, e[0]))[0]
