import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from skytally.constants import AIRPORTS, BOX, ZONES
from skytally.functions import geo, numbers, scoring, text, times
from skytally.operators.cleaning import filter_any


def value(spark, column, data=("x",), ddl="c STRING"):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], ddl).select(column).collect()]


def test_airline_from_callsign(spark):
    calls = [None, "AIC77", "SVA20X", "  igo3", "ETD9", "\t", "QQQ1", "PIA8 ", "uae1A", "XY9", "QTR0", ""]
    assert value(spark, text.airline_name(F.col("c")), calls) == [
        "Unknown / private", "Air India", "Saudia", "IndiGo", "Etihad Airways", "Unknown / private", "Other",
        "Pakistan International", "Emirates", "flynas", "Qatar Airways", "Unknown / private",
    ]


def test_blank_becomes_null(spark):
    assert value(spark, text.blank_to_null(F.col("c")), [" \n", "KAC7 ", None, ""]) == [None, "KAC7", None, None]


def test_colours(spark):
    assert value(spark, text.hex_to_rgba(F.lit("#2a78d6"))) == [[42, 120, 214, 255]]


def test_numbers_from_text(spark):
    got = value(spark, numbers.to_double(F.col("c")), ["12.5", " 3 ", "", "abc", "3d", "2.5F", "NaN", None, "-1e3"])
    assert got == [12.5, 3.0, None, None, None, None, None, None, -1000.0]


def test_exact_decimals(spark):
    got = value(spark, numbers.to_exact_decimal(F.col("c")).cast("string"), [0.1, float("nan"), None, 45.0], "c DOUBLE")
    assert got == ["0.100000000000000000", None, None, "45.000000000000000000"]


def test_compact_time(spark):
    column = times.iso_utc(times.parse_compact(F.col("c")))
    assert value(spark, column, ["20260728153000", "bad", "", None]) == ["2026-07-28T15:30:00Z", None, None, None]


def test_bucket_start(spark):
    got = value(spark, times.bucket_start(F.col("c"), 5).cast("bigint"), [1699999800, 1699999800 + 299, 1699999800 + 300], "c BIGINT")
    assert got == [1699999800, 1699999800, 1700000100]


def test_distance(spark):
    by_code = {code: (lat, lon) for code, lat, lon in AIRPORTS}
    points = [F.lit(v) for v in (*by_code["DXB"], *by_code["AUH"])]
    assert 110 < value(spark, geo.haversine_km(*points))[0] < 125
    assert value(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))[0] == pytest.approx(math.pi * 6371)


def test_zones(spark):
    """The middle of each zone that no earlier zone holds, a corner, and points outside."""
    for number, (name, south, north, west, east) in enumerate(ZONES):
        spots = [((south + north) / 2, (west + east) / 2), (south, west), (south - 0.01, west), (None, west)]
        rows = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "i INT, a DOUBLE, b DOUBLE").orderBy("i")
        own = [r[0] for r in rows.select(geo.zone_of(F.col("a"), F.col("b"), ZONES[number:])).collect()]
        assert own[:2] == [name, name] and own[2] != name and own[3] is None


def test_box_edges_are_inside(spark):
    rows = [(BOX["lat_min"], BOX["lon_min"]), (BOX["lat_max"], BOX["lon_max"]), (BOX["lat_max"] + 1e-9, 40.0), (None, 40.0)]
    points = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    assert [r[0] for r in points.select(geo.in_box(F.col("a"), F.col("b"))).collect()] == [True, True, False, False]


def nearest(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, latitude DOUBLE, longitude DOUBLE")
    return [r[0] for r in geo.assign_nearest(df, **options).orderBy("i").select("nearest_region").collect()]


def test_nearest_airport(spark):
    rows = [(lat + 0.03, lon - 0.04) for _, lat, lon in AIRPORTS] + [(-41.0, 12.0), (None, 41.0), (27.0, None)]
    assert nearest(spark, rows) == [code for code, _, _ in AIRPORTS] + ["OTHER", None, None]


def test_positions_off_the_globe_are_in_no_region(spark):
    rows = [(1e300, 50.0), (math.inf, 50.0), (91.0, 50.0), (-1e17, 50.0), (25.0, 1e300), (25.0, -math.inf), (math.nan, 50.0)]
    assert nearest(spark, rows) == ["OTHER"] * 7


def test_far_off_times(spark):
    days = value(spark, times.partition_date(F.col("c")), [10**17, -(10**17), 86400, None], "c BIGINT")
    assert [d and d.isoformat() for d in days] == [None, None, "1970-01-02", None]
    assert value(spark, times.bucket_start(F.col("c"), 5).isNull(), [10**17, 86400], "c BIGINT") == [True, False]


def test_only_plain_numbers_and_whole_decimals(spark):
    texts = ["0x1p3", "1_0", "Infinity", "+.5", "7.", "1e2", "--1", "٣"]
    assert value(spark, numbers.to_double(F.col("c")), texts) == [None, None, None, 0.5, 7.0, 100.0, None, None]
    exact = value(spark, numbers.to_exact_decimal(F.col("c")), [1e25, 1e-19, 0.1, -12.5, math.nan, None, math.inf], "c DOUBLE")
    assert [x if x is None else float(x) for x in exact] == [None, None, 0.1, -12.5, None, None, None]


def test_first_listed_wins_a_tie(spark):
    points = [("B", 10.0, 20.0), ("A", 10.0, 20.0)]
    assert nearest(spark, [(10.1, 20.1)], points=points) == ["B"]


def test_cutoff_is_inclusive(spark):
    step = math.degrees(150 / 6371.0)
    points = [("P", 0.0, 0.0)]
    assert nearest(spark, [(step * (1 - 1e-9), 0.0), (step * (1 + 1e-6), 0.0)], points=points) == ["P", "OTHER"]


def _km(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("count, max_km, broadcast_bytes", [(3, 2500.0, 1 << 23), (300, 400.0, 1 << 23), (300, 400.0, 0)])
def test_nearest_against_brute_force(spark, monkeypatch, count, max_km, broadcast_bytes):
    """Anywhere on the globe: across the date line, at the poles, with and without broadcast."""
    monkeypatch.setattr(geo, "BROADCAST_BYTES", broadcast_bytes)
    rng = random.Random(7)
    points = [(f"P{i}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(count)] + [("N", 89.9, 10.0), ("D", 0.0, 179.9)]
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)] + [(89.5, -170.0), (0.3, -179.9), (-90.0, 5.0)]
    expected = []
    for lat, lon in rows:
        km, order = min((_km(lat, lon, p[1], p[2]), i) for i, p in enumerate(points))
        expected.append(points[order][0] if km <= max_km else "OTHER")
    assert nearest(spark, rows, points=points, max_km=max_km) == expected


def test_tiers_and_boundaries(spark):
    z = [0.0, 1.4999, 1.5, -2.4999, 2.5, 3.4999, -3.5, 99.0, None, 1.5 - 1e-12]
    got = value(spark, scoring.tier(F.col("c")), z, "c DOUBLE")
    assert got == ["normal", "normal", "warning", "warning", "serious", "serious", "critical", "critical", "insufficient_baseline", "warning"]


def test_empty_selection_means_all(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x STRING")
    assert rows_of(filter_any(df, "x", [])) == rows_of(filter_any(df, "x", None)) == [("a",), ("b",)]
    assert rows_of(filter_any(df, "x", ["b"])) == [("b",)]
