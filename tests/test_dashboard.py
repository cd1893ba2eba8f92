import json

from conftest import rows_of
from pyspark.sql import functions as F
from skytally.operators import events, kpis, mapview, serving
from skytally.schemas import EVENTS, STATES, TRAFFIC


def states(spark, rows):
    """(airline, region, lat, lon, altitude, speed) rows."""
    defaults = dict.fromkeys(STATES.fieldNames())
    names = ["airline", "nearest_region", "latitude", "longitude", "baro_altitude", "velocity"]
    return spark.createDataFrame([tuple((defaults | dict(zip(names, r))).values()) for r in rows], STATES)


def test_kpis(spark):
    df = states(spark, [("Emirates", "DXB", 30.0, 45.0, 3000.0, 100.0), ("Emirates", "DXB", 15.0, 50.0, 3000.1, None),
                        ("Saudia", "JED", 0.0, 0.0, None, 300.0), ("Other", "DOH", 0.0, 0.0, 9000.0, None), ("Other", "DOH", 0.0, 0.0, -5.0, None)])
    assert rows_of(kpis.kpi_summary(df)) == [(5, 3, "DOH")]  # a tie goes to the first name
    assert rows_of(kpis.zone_counts(df)) == [("Iran", 1), ("Yemen", 1)]
    assert [tuple(r) for r in kpis.altitude_bands(df).collect()] == [(0, "<10k ft", 1), (1, "10-30k ft", 2), (2, ">30k ft", 0)]
    row = kpis.altitude_speed(df).first()
    assert abs(row.altitude_ft - (3000 + 3000.1 + 9000 - 5) / 4 * 3.28084) < 1e-6 and abs(row.speed_kt - 200 * 1.94384) < 1e-9
    assert [r.airline for r in kpis.airline_list(df).collect()] == ["Emirates", "Other", "Saudia"]
    shares = {r.airline: (r.share, r.colour) for r in kpis.top_airlines(df, 2).collect()}
    assert shares == {"Emirates": (0.5, "#2a78d6"), "Other": (0.5, "#898781")}


def test_kpis_without_rows(spark):
    empty = states(spark, [])
    assert rows_of(kpis.kpi_summary(empty)) == [(0, 0, None)]
    assert kpis.altitude_speed(empty).count() == 0
    assert [r.aircraft for r in kpis.altitude_bands(empty).collect()] == [0, 0, 0]
    assert rows_of(kpis.detour_cost(empty)) == [(0, 0, 0, 5000)]


def test_detour_cost(spark):
    df = states(spark, [("Emirates",)] * 4 + [("Gulf Air",)] * 6 + [("Other",)] * 3)
    assert rows_of(kpis.detour_cost(df)) == [(10, 37500, 100000, 5000)]
    assert rows_of(kpis.detour_cost(df, use_full_operating_cost=True)) == [(10, 45000, 120000, 6000)]


def labels(spark, counts):
    df = spark.createDataFrame([(name,) for name, n in counts.items() for _ in range(n)], "nearest_region STRING")
    return {r.nearest_region: r.label for r in kpis.ranked_labels(df, "nearest_region").collect()}


def test_labels(spark):
    assert labels(spark, {"a": 5, "b": 4, "c": 2, "d": 2, "e": 1}) == {"a": "5", "b": "4", "c": "2", "d": "2", "e": ""}
    assert labels(spark, {"a": 5, "b": 4}) == {"a": "5", "b": ""}
    assert labels(spark, {"a": 5, "b": 5, "c": 5, "d": 5}) == dict.fromkeys("abcd", "5")
    bars = kpis.top_airlines_bar(states(spark, [(f"X{i:02}",) for i in range(12) for _ in range(i + 1)])).collect()
    assert [r.aircraft for r in bars] == [5, 6, 7, 8, 9, 10, 11, 12] and bars[-1].label == "12"


def board(spark):
    rows = [("DXB", "critical"), ("DOH", "normal"), ("KWI", "warning"), ("RUH", "odd"), ("JED", "normal")]
    return spark.createDataFrame(rows, "region STRING, anomaly_status STRING")


def test_status_board(spark):
    assert rows_of(kpis.alert_count(board(spark))) == [(2,)]
    assert [(r.anomaly_status, r.regions) for r in kpis.status_counts(board(spark)).collect()] == [
        ("critical", 1), ("warning", 1), ("normal", 2), ("odd", 1)]
    assert [(r.region, r.icon) for r in kpis.alert_board(board(spark)).collect()] == [
        ("DXB", "✖"), ("KWI", "⚠"), ("DOH", "✓"), ("JED", "✓"), ("RUH", "•")]


def test_halos_and_corridors(spark):
    halos = {r.region: (r.anomaly_status, r.halo) for r in mapview.airport_halos(board(spark)).collect()}
    assert len(halos) == 15 and halos["DXB"] == ("critical", [208, 59, 59, 140])
    assert halos["CAI"] == ("insufficient_baseline", [137, 135, 129, 50]) and halos["RUH"] == ("odd", None)
    df = states(spark, [("Emirates", "DXB", 25.0, 55.0), ("Saudia", "JED", 21.0, 39.0), ("Emirates", "OTHER", 15.0, 50.0)])
    lines = {r.nearest_region: (r.target_longitude, r.target_latitude, r.colour) for r in mapview.corridors(df).collect()}
    assert lines == {"DXB": (55.3657, 25.2532, [42, 120, 214, 90]), "JED": (39.1565, 21.6796, [137, 135, 129, 90])}
    rings = {r.zone: (r.polygon, r.aircraft) for r in mapview.zone_polygons(df).collect()}
    assert rings["Yemen"] == ([[42.5, 12.1], [54.5, 12.1], [54.5, 19.0], [42.5, 19.0]], 1) and rings["Iraq"][1] == 0
    assert {r.angle for r in mapview.map_points(df).collect()} == {0.0}


def conflict(spark, rows):
    """(id, mentions, goldstein, actor) rows."""
    defaults = dict.fromkeys(EVENTS.fieldNames())
    names = ["global_event_id", "num_mentions", "goldstein_scale", "actor1_name", "action_geo_lat"]
    return spark.createDataFrame([tuple((defaults | {"nearest_region": "DXB"} | dict(zip(names, r))).values()) for r in rows], EVENTS)


def test_top_events(spark):
    rows = [(f"{i}", float(i), -7.0) for i in range(10)] + [("n", None, None), ("big", 500.0, -7.1)]
    got = {r.global_event_id: r for r in events.top_events(conflict(spark, rows)).collect()}
    assert set(got) == {"big", "9", "8", "7", "6", "5", "4", "3"} and got["9"].total_events == 12
    assert (got["big"].marker_size, got["big"].marker_colour) == (50 / 3 + 8, "#d03b3b") and got["9"].marker_colour == "#ec835a"
    empty = spark.createDataFrame([], TRAFFIC)
    assert {r.y for r in events.trend_overlay(empty, conflict(spark, rows)).collect()} == {1.0}


def scored(spark):
    rows = [("A", 1767225600, 50, 45.0, 3.0, 20, 1.6, "warning", "spike"), ("B", 1767225600, 5, None, float("nan"), 3, None, "insufficient_baseline", None)]
    ddl = "region STRING, at BIGINT, aircraft_count BIGINT, rolling_mean DOUBLE, rolling_std DOUBLE, baseline_n BIGINT, z_score DOUBLE, anomaly_status STRING, anomaly_direction STRING"
    return spark.createDataFrame(rows, ddl).withColumn("bucket_sk", F.timestamp_seconds("at")).select(*TRAFFIC.fieldNames())


def test_traffic_items(spark):
    items = serving.serving_traffic(scored(spark))
    got = {r.region_pk: json.loads(i.item) for r, i in zip(items.orderBy("region_pk").collect(), serving.as_json(items.orderBy("region_pk")).collect())}
    assert got["REGION#A"]["bucket_sk"] == "BUCKET#2026-01-01T00:00:00+00:00"
    assert got["REGION#A"]["status_gsi_pk"] == "STATUS#warning" and got["REGION#A"]["aircraft_count"] == 50
    assert set(got["REGION#B"]) == {"region_pk", "bucket_sk", "aircraft_count", "baseline_n", "anomaly_status"}
    back = serving.decode_traffic(items)
    assert rows_of(back) == rows_of(scored(spark).select(*back.columns))
    unknown = serving.decode_traffic(items.withColumn("anomaly_status", F.lit(None).cast("string")))
    assert {r.anomaly_status for r in unknown.collect()} == {"insufficient_baseline"}


def test_event_items(spark):
    items = serving.serving_events(conflict(spark, [("1", 50.0, -9.5, ""), ("2", None, None, "X")]))
    got = {r.event_pk: r for r in items.collect()}
    assert got["EVENT#1"].actor1_name is None and got["EVENT#2"].actor1_name == "X"
    assert str(got["EVENT#1"].goldstein_scale) == "-9.500000000000000000" and got["EVENT#2"].num_mentions is None
    assert got["EVENT#1"].region_gsi_pk == "REGION#DXB"
