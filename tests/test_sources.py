import json
import zipfile

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from skytally.functions.times import iso_utc
from skytally.operators.cleaning import clean_events, clean_states
from skytally.schemas import COUNTS, EVENTS, EXPORT_COLUMNS, RECORD, STATES
from skytally.sources import exports, polls, records, tables


def vector(**fields):
    """A 17-value state vector."""
    v = ["7f00aa", "KAC771 ", "Kuwait", 3, 4, 47.98, 29.22, 8400, False, 211.25, 305, 2.5, None, 8520.5, None, True, 1]
    for position, value in fields.items():
        v[int(position[1:])] = value
    return v


def write_poll(path, time, states):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"time": time, "states": states}, indent=1))


def test_flatten_polls(spark, tmp_path):
    folder = tmp_path / "polls"
    states = [vector(), vector(_1="        "), vector(_0=None), vector(_0=""), [], None, vector(_0="nopos", _5=None, _6=None)]
    write_poll(folder / "a.json", 1769000400, states)
    write_poll(folder / "b.json", 2, [])
    write_poll(folder / "c.json", 3, None)
    out = polls.flatten_states(polls.read_polls(spark, str(folder)))
    assert out.columns == RECORD.fieldNames() and out.schema["on_ground"].dataType.simpleString() == "boolean"
    got = {(r.icao24, r.callsign): r for r in out.collect()}
    assert set(got) == {("7f00aa", "KAC771"), ("7f00aa", None), ("nopos", "KAC771")}
    row = got["7f00aa", "KAC771"]
    assert (row.longitude, row.latitude, row.baro_altitude, row.on_ground, row.velocity) == (47.98, 29.22, 8400.0, False, 211.25)
    assert (row.true_track, row.vertical_rate, row.geo_altitude, row.poll_timestamp) == (305.0, 2.5, 8520.5, 1769000400)
    assert got["nopos", "KAC771"].latitude is None


def test_a_response_that_was_cut_off_is_set_aside(spark, tmp_path):
    folder = tmp_path / "polls"
    write_poll(folder / "a.json", 1769000400, [vector()])
    (folder / "b.json").write_text((folder / "a.json").read_text()[:-9])
    assert polls.flatten_states(polls.read_polls(spark, str(folder))).count() == 1
    assert [r.file for r in polls.malformed_polls(spark, str(folder)).collect()] == ["b.json"]


def test_records_skip_blank_lines_and_fill_missing_fields(spark, tmp_path):
    folder = tmp_path / "dt=2026-01-01"
    folder.mkdir()
    lines = ['{"icao24": "a", "latitude": 25.2532, "longitude": 55.3657}', "", "   ", '{"icao24": "cut", "lat', '{"icao24": "b", "poll_timestamp": 5}']
    (folder / "x.ndjson").write_text("\n".join(lines))
    read = records.read_records(spark, str(tmp_path))
    assert rows_of(read, "icao24", "callsign", "poll_timestamp", "on_ground") == [("a", None, None, None), ("b", None, 5, None)]
    assert [r.body for r in records.malformed_records(spark, str(tmp_path)).collect()] == ['{"icao24": "cut", "lat']
    cleaned = clean_states(read)
    assert cleaned.columns == STATES.fieldNames()
    assert rows_of(cleaned, "icao24", "airline", "nearest_region") == [("a", "Unknown / private", "DXB")]


def test_clean_empty_and_nan(spark):
    assert clean_states(spark.createDataFrame([], RECORD)).columns == STATES.fieldNames()
    row = dict.fromkeys(RECORD.fieldNames()) | {"icao24": "a", "latitude": float("nan"), "longitude": 1.0}
    assert clean_states(spark.createDataFrame([tuple(row.values())], RECORD)).count() == 0


def test_messages_round_trip(spark):
    rows = spark.createDataFrame([tuple(["a", None, "X", 1.0, 2.0, None, True, 3.0, 4.0, 5.0, None, 7])], RECORD)
    messages = records.encode(rows)
    assert messages.first().key == "a" and "callsign" not in json.loads(messages.first().value)
    assert rows_of(records.decode(messages)) == rows_of(rows)


def test_a_dominant_aircraft_is_spread(spark):
    rows = spark.range(0, 24 * 3600, 600).selectExpr("'hot' AS icao24", "id AS poll_timestamp")
    assert records.spread(rows, 4).select(F.spark_partition_id()).distinct().count() > 1


def line(**fields):
    cells = dict.fromkeys(EXPORT_COLUMNS, "") | {
        "GLOBALEVENTID": "1", "Actor1Name": "IRAQ", "EventCode": "190", "QuadClass": "4", "GoldsteinScale": "-9.5",
        "NumMentions": "10", "NumSources": "2", "NumArticles": "5", "ActionGeo_CountryCode": "SA",
        "ActionGeo_Lat": "24.95", "ActionGeo_Long": "46.69", "DATEADDED": "20260728153000", "SOURCEURL": "http://x/1",
    } | fields
    return "\t".join(cells.values())


def write_zip(path, lines, member="20260728.export.CSV"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr(member, "\n".join(lines))
        archive.writestr("second.txt", "ignored")


def test_exports_are_unzipped_parsed_and_cleaned(spark, tmp_path):
    lines = [
        line(),
        line(GLOBALEVENTID="2", ActionGeo_Lat="12.0", ActionGeo_Long="31.0", QuadClass="3"),  # both edges
        line(GLOBALEVENTID="3", ActionGeo_Lat="37.5", ActionGeo_Long="63.3", DATEADDED="bad", GoldsteinScale="x"),
        line(GLOBALEVENTID="4", ActionGeo_Lat="31.72", ActionGeo_Long="35.99", Actor1Name='A "QUOTE', NumMentions=""),
        line(GLOBALEVENTID="5", QuadClass="2"),
        line(GLOBALEVENTID="6", QuadClass=""),
        line(GLOBALEVENTID="7", ActionGeo_Lat=""),
        line(GLOBALEVENTID="8", ActionGeo_Lat="text"),
        line(GLOBALEVENTID="9", ActionGeo_Lat="51.5", ActionGeo_Long="0.1"),
        line(GLOBALEVENTID="10").rsplit("\t", 1)[0],  # the last field is missing
        line(GLOBALEVENTID="11") + "\tsurplus",
        "only\tthree\tfields",
        "",
    ]
    write_zip(tmp_path / "20260728153000.export.CSV.zip", lines)
    write_zip(tmp_path / "20260728154500.export.CSV.zip", [line(GLOBALEVENTID="12")])
    write_zip(tmp_path / "20260728160000.export.CSV.zip", [])
    (tmp_path / "readme.txt").write_text("not a zip")
    raw = exports.read_exports(spark, str(tmp_path))
    out = clean_events(raw, keep=("source_file",))
    got = {r.global_event_id: r for r in out.collect()}
    assert set(got) == {"1", "2", "3", "4", "10", "11", "12"}
    assert clean_events(raw).schema == EVENTS or clean_events(raw).columns == EVENTS.fieldNames()
    assert got["1"].nearest_region == "RUH" and got["1"].quad_class == 4 and got["1"].num_mentions == 10.0
    at = out.filter("global_event_id = '1'").select(iso_utc(F.col("event_timestamp"))).first()[0]
    assert at == "2026-07-28T15:30:00Z"
    assert got["3"].event_timestamp is None and got["3"].goldstein_scale is None
    assert got["4"].nearest_region == "AMM" and got["4"].actor1_name == 'A "QUOTE' and got["4"].num_mentions is None
    assert got["10"].source_url is None and got["11"].source_url == "http://x/1"
    assert got["12"].source_file == "20260728154500.export.CSV.zip"


def test_all_export_columns_can_be_read(spark, tmp_path):
    write_zip(tmp_path / "a.export.CSV.zip", [line()])
    read = exports.read_exports(spark, str(tmp_path), EXPORT_COLUMNS)
    assert read.columns == ["source_file", *EXPORT_COLUMNS]
    assert read.first().Actor1Code is None and read.first().QuadClass == "4"


def test_listing(spark):
    listing = ["  1 aa http://h/20260101000000.mentions.CSV.zip", "2 bb http://h/20260101000000.export.CSV.zip ", "", "short line",
               "3 cc http://h/20260101001500.export.CSV.zip"]
    df = spark.createDataFrame([(x,) for x in listing], "value STRING")
    assert exports.export_urls(df).count() == 2
    assert exports.latest_export_url(df).first().url == "http://h/20260101001500.export.CSV.zip"
    with pytest.raises(PySparkException, match="export"):
        exports.latest_export_url(df.limit(1)).collect()


def test_batches_replace_themselves_and_newest_wins(spark, tmp_path, series):
    path = str(tmp_path / "counts")
    assert tables.read_current(spark, path, COUNTS, ["region", "bucket_sk"]).count() == 0
    tables.write_batch(series(("A", [1, 2, 3])), path, 0)
    tables.write_batch(series(("A", [9])), path, 1)
    for _ in range(2):
        tables.write_batch(series(("A", [7, 8]), ("B", [5])), path, 2)  # a replay changes nothing
    current = tables.read_current(spark, path, COUNTS, ["region", "bucket_sk"])
    assert [r.aircraft_count for r in current.orderBy("region", "bucket_sk").collect()] == [7, 8, 3, 5]
    tables.compact(spark, path, str(tmp_path / "compact"), COUNTS, ["region", "bucket_sk"])
    again = tables.read_current(spark, str(tmp_path / "compact"), COUNTS, ["region", "bucket_sk"])
    assert rows_of(again) == rows_of(current)
    assert tables.read_log(spark, str(tmp_path / "compact"), COUNTS).select("batch_id").distinct().first()[0] == 2


def test_newest_file(spark, tmp_path):
    import os

    for at, name in ((100, "old"), (300, "new"), (200, "mid")):
        folder = tmp_path / f"dt=2026-01-0{at // 100}"
        folder.mkdir()
        (folder / f"{name}.ndjson").write_text(json.dumps({"icao24": name}))
        os.utime(folder / f"{name}.ndjson", (at, at))
    assert rows_of(tables.read_newest_file(spark, str(tmp_path), RECORD), "icao24") == [("new",)]
    listing = tables.list_files(spark, str(tmp_path), "*.ndjson")
    assert listing.count() == 3 and listing.filter("bytes > 0").count() == 3
    assert [str(d[0]) for d in rows_of(tables.expired_partitions(listing, "2026-02-01", 30))] == ["2026-01-01"]


def test_live_states_fall_back(spark, tmp_path):
    live, bronze = tmp_path / "live", tmp_path / "bronze"
    empty, label = polls.live_states(spark, str(live), str(bronze))
    assert (empty.count(), empty.columns, label) == (0, STATES.fieldNames(), "unavailable")
    import os

    for at, name in ((3600, "old"), (7260, "new")):
        (bronze / f"dt=2026-01-0{at // 3600}").mkdir(parents=True)
        path = bronze / f"dt=2026-01-0{at // 3600}" / "x.json"
        path.write_text(json.dumps({"icao24": name, "latitude": 25.25, "longitude": 55.36}))
        os.utime(path, (at, at))
    cached, label = polls.live_states(spark, str(live), str(bronze))
    assert (rows_of(cached, "icao24", "nearest_region"), label) == ([("new", "DXB")], "cached (from 02:01 UTC)")
    write_poll(live / "now.json", 5, [vector()])
    states, label = polls.live_states(spark, str(live), str(bronze))
    assert (rows_of(states, "icao24", "nearest_region"), label) == ([("7f00aa", "KWI")], "live")


def test_unprocessed_files(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file_name STRING")
    known = files.filter("file_name = 'a'")
    assert rows_of(tables.unprocessed(files, known)) == [("b",)]
    assert rows_of(tables.unprocessed(files, known, force=True)) == [("a",), ("b",)]


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert tables.read_manifest(spark, path).count() == 0
    for batch, etag in enumerate(("first", "second")):
        entry = tables.manifest_row(spark, "exports", etag, "2026-01-01 00:00:00", "key", "success", {"shard-0": str(batch)})
        tables.write_batch(entry, f"{path}/source=exports", batch)
    manifest = tables.read_manifest(spark, path)
    assert rows_of(tables.stored_etag(manifest, "exports")) == [("second",)]
    assert tables.stored_etag(manifest, "unknown").count() == 0
    assert manifest.first().shard_checkpoints == {"shard-0": "1"}


def test_checkpoints_merge(spark):
    pairs = [({"a": "1", "b": "1"}, {"b": "2", "c": "3"}), (None, {"a": "9"}), ({"a": "1"}, None)]
    df = spark.createDataFrame(pairs, "old MAP<STRING,STRING>, new MAP<STRING,STRING>")
    merged = [r[0] for r in df.select(tables.merge_checkpoints(F.col("old"), F.col("new"))).collect()]
    assert merged == [{"a": "1", "b": "2", "c": "3"}, {"a": "9"}, {"a": "1"}]
