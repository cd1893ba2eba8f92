"""Keyed tables, small files, large responses, stored zips, matched streams."""

import json
import zipfile

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from skytally.operators import correlation, dedup
from skytally.operators.cleaning import clean_events
from skytally.plans import adapters, jobs
from skytally.plans.registry import QUERIES
from skytally.schemas import COUNTS, EVENTS
from skytally.sources import exports, files, polls, tables
from skytally.sources.keyed import KeyedTable
from skytally.streaming import correlation as streams
from skytally.streaming import gold, ingest

DAY = 86_400


def counts(spark, rows):
    df = spark.createDataFrame(rows, "region STRING, at BIGINT, aircraft_count BIGINT")
    return df.select("region", F.timestamp_seconds("at").alias("bucket_sk"), "aircraft_count")


def versions(path):
    return {p.parent.name[3:]: p.name for p in path.glob("data/dt=*/v=*")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- keyed tables ---------------------------------------------------------------------------------------


def test_an_upsert_rewrites_the_days_it_touches(spark, tmp_path):
    table = gold.counts_table(spark, str(tmp_path))
    assert table.read().count() == 0 and table.parts() == []
    month = counts(spark, [(r, d * DAY + h * 3600, d + h) for r in "AB" for d in range(30) for h in range(4)])
    assert sum(table.merge(month, 0).values()) == 240
    before = versions(tmp_path)
    assert len(before) == 30 and set(before.values()) == {"v=0"}
    changed = counts(spark, [("A", 7 * DAY, 99), ("C", 7 * DAY, 1)])
    for _ in range(2):  # once more is the same
        assert table.merge(changed, 1) == {"1970-01-08": 2}
        assert table.snapshot()[1] == {**{d: 0 for d in before}, "1970-01-08": 1}
        assert {p.name for p in tmp_path.glob("data/dt=1970-01-08/v=*")} == {"v=0", "v=1"}  # the one before is still there
        assert sum(1 for _ in tmp_path.glob("data/dt=*/v=*")) == 31
        expected = rows_of(month.filter("not (region = 'A' and bucket_sk = timestamp_seconds(7 * 86400))").union(changed))
        assert rows_of(table.read()) == expected
    assert rows_of(table.read("1970-01-08", "1970-01-08")) == [r for r in expected if r[1].day == 8]
    # A batch that dies before its version file is in place is not there.
    table.merge(counts(spark, [("A", 8 * DAY, 7)]), 2)
    (tmp_path / "versions" / "2.json").unlink()
    assert rows_of(table.read()) == expected
    table.merge(counts(spark, []), 3)
    assert rows_of(table.read()) == expected


def test_folders_follow_the_parts_and_not_the_batches(spark, tmp_path):
    table = gold.counts_table(spark, str(tmp_path))
    for batch in range(12):
        table.merge(counts(spark, [("A", DAY * (batch // 6), batch), ("B", batch * 60, batch)]), batch)
    assert sum(1 for _ in tmp_path.glob("data/dt=*/v=*")) <= 4
    assert len(list((tmp_path / "versions").glob("*.json"))) == 2
    assert rows_of(table.read().filter("region = 'A'"), "aircraft_count") == [(11,), (5,)]


def test_filters_skip_what_they_do_not_need(spark, tmp_path):
    table = gold.counts_table(spark, str(tmp_path))
    table.merge(counts(spark, [(r, d * DAY, d) for r in "AB" for d in range(9)]), 0)
    found = table.read(first="1970-01-07").filter("region = 'B' and bucket_sk >= timestamp'1970-01-08 00:00:00'")
    assert "EqualTo(region,B)" in plan(found) and "GreaterThanOrEqual(bucket_sk" in plan(found)
    assert len(found.inputFiles()) <= 3 and rows_of(found, "aircraft_count") == [(7,), (8,)]


def test_replace_and_forget(spark, tmp_path):
    table = gold.counts_table(spark, str(tmp_path))
    table.merge(counts(spark, [("A", d * DAY, d) for d in range(3)]), 0)
    table.replace(counts(spark, [("Z", DAY, 5)]), ["1970-01-01", "1970-01-02"], 1)
    assert rows_of(table.read(), "region", "aircraft_count") == [("A", 2), ("Z", 5)]
    table.forget(["1970-01-03", "2000-01-01"], 1)
    assert rows_of(table.read(), "region", "aircraft_count") == [("Z", 5)]
    assert not (tmp_path / "data" / "dt=1970-01-03").exists()


def test_an_order_column_decides(spark, tmp_path):
    events = jobs.events_table(spark, str(tmp_path))

    def pull(version, *rows):
        df = spark.createDataFrame([(i, n) for i, n in rows], "global_event_id STRING, num_mentions DOUBLE")
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS.fields if f.name not in df.columns]
        return df.select("*", *missing, F.lit(version).cast("bigint").alias("version"))

    events.merge(pull(20, ("1", 1.0), ("250000", 2.0), (None, 3.0), ("x", 4.0)), 0)
    assert events.parts() == ["0", "2", "other"]
    events.merge(pull(10, ("1", 9.0), ("2", 9.0)), 1)  # an older export that came later
    assert rows_of(events.read(), "global_event_id", "num_mentions") == rows_of(
        spark.createDataFrame([("1", 1.0), ("2", 9.0), ("250000", 2.0), (None, 3.0), ("x", 4.0)], "global_event_id STRING, num_mentions DOUBLE")
    )


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    assert files.names(spark, str(tmp_path / "none")) == [] and not files.has_files(spark, str(tmp_path))
    for text in ("one", "zwei ü"):
        files.put_text(spark, path, text)
        assert files.get_text(spark, path) == text
    assert files.has_files(spark, str(tmp_path)) and "x.json" in files.names(spark, str(tmp_path / "a"))
    files.remove(spark, path)
    assert not (tmp_path / "a" / "x.json").exists()


# ---- keep-last ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["merge_history", "gold_events"])
def test_keep_last_sorts_no_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    assert "SortAggregate" not in plan(df)


def test_keep_last_of_many_copies(spark):
    rows = [("hot", i % 50, f"v{i % 50}") for i in range(2000)] + [(None, None, "n"), (None, -5, "m"), ("k", -(1 << 63), "least"), ("k", (1 << 63) - 1, "most")]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT, text STRING")
    found = dedup.latest_by_key(df, ["k"], "v")
    assert rows_of(found) == rows_of(spark.createDataFrame([("hot", 49, "v49"), (None, -5, "m"), ("k", (1 << 63) - 1, "most")], df.schema))
    tied = spark.createDataFrame([("a", 1, x) for x in "pqr"] * 3, df.schema)
    one = dedup.latest_by_key(tied, ["k"], "v").collect()
    assert one == dedup.latest_by_key(tied.orderBy(F.desc("text")).repartition(3), ["k"], "v").collect() and len(one) == 1
    with pytest.raises(TypeError):
        dedup.latest_by_key(df, ["v"], "text")


# ---- responses of any size ----------------------------------------------------------------------------------


def vector(name, **fields):
    values = [name, "UAE85  ", "X", 1, 2, 55.5, 25.25, 100.5, False, 1.5, 90, 0, None, 5, None, False, 0]
    for position, value in fields.items():
        values[int(position[1:])] = value
    return values


RESPONSES = {
    "plain": json.dumps({"time": 10, "states": [vector("a"), vector("b"), None, vector(""), vector(None)]}),
    "tight": json.dumps({"time": 11, "states": [vector("c")]}, separators=(",", ":")),
    "lines": json.dumps({"time": 12, "states": [None, vector("d"), vector("e", _6=None)]}, indent=2),
    "behind": '{"states": [["f"], ["g", null]], "time": 13, "more": "x"}\n',
    "none": '{"time": 14, "states": null}',
    "empty": '{"time": 15, "states": []}',
    "nulls": '{"time": 16, "states": [null, null]}',
    "sensors": json.dumps({"time": 17, "states": [vector("h", _12=[1, 2]), vector("i")]}),
    "bracket": json.dumps({"time": 18, "states": [vector("j", _2="a]b[c"), vector("k")]}),
    "cut": json.dumps({"time": 19, "states": [vector("l"), vector("m")]})[:-40],
    "cut-clean": json.dumps({"time": 20, "states": [vector("n"), vector("o")]})[:-2],
    "cut-end": json.dumps({"time": 21, "states": [vector("p")]})[:-1],
    "junk": "no json",
    "blank": "",
    "far": json.dumps({"time": 10**15, "states": [vector("q", _6="NaN", _8="maybe")]}),
}


def test_pieces_give_what_whole_texts_give(spark, tmp_path):
    for name, body in RESPONSES.items():
        (tmp_path / f"{name}.json").write_text(body)
    whole = polls.flatten_states(polls.read_polls(spark, str(tmp_path)))
    found = polls.scan_states(spark, str(tmp_path))
    assert found.columns == whole.columns and rows_of(found) == rows_of(whole)
    assert {r.icao24 for r in found.collect()} == set("abcdefghijkq")


def test_a_large_response_is_read_in_parts(spark, tmp_path):
    """Four tasks share one file, and no piece is longer than a vector."""
    body = json.dumps({"time": 10, "states": [vector(f"p{i}") for i in range(20_000)]})
    (tmp_path / "big.json").write_text(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(body) // 4 + 1))
    try:
        pieces = spark.read.text(str(tmp_path), lineSep="]")
        assert pieces.rdd.getNumPartitions() >= 4
        assert pieces.agg(F.max(F.length("value"))).first()[0] < 300
        assert polls.scan_states(spark, str(tmp_path)).select("icao24").distinct().count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ---- stored zips --------------------------------------------------------------------------------------------


def test_zips_are_written_and_found_again(spark, tmp_path):
    lines = adapters.export_lines(spark, SMALL).repartition(3)
    exports.write_exports(lines, str(tmp_path / "zips"), 150)
    stored = sorted((tmp_path / "zips").iterdir())
    assert len(stored) == 9 and all(p.name.endswith(exports.EXPORT_SUFFIX) for p in stored)  # three of each task
    sizes = [len(zipfile.ZipFile(p).read(zipfile.ZipFile(p).namelist()[0]).splitlines()) for p in stored]
    assert sum(sizes) == lines.count() and max(sizes) == 150
    found = clean_events(exports.read_exports(spark, str(tmp_path / "zips")))
    assert rows_of(found) == rows_of(adapters.conflicts(spark, SMALL))
    exports.write_exports(lines.limit(0), str(tmp_path / "zips"))
    assert len(list((tmp_path / "zips").iterdir())) == 9


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    bad = spark.range(40).repartition(4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).cast("string").alias("line"))
    with pytest.raises(Exception, match="lost"):
        exports.write_exports(bad, str(tmp_path / "zips"))
    assert not list((tmp_path / "zips").rglob("*.zip"))


# ---- listings -------------------------------------------------------------------------------------------------


def test_newest_file_of_the_last_folders(spark, tmp_path):
    for day in ("01", "02", "03"):
        (tmp_path / f"dt=2026-01-{day}").mkdir()
        (tmp_path / f"dt=2026-01-{day}" / "x.json").write_text("{}")
    newest = tables.newest_file(spark, str(tmp_path), "*.json", folders=1)
    assert "dt=2026-01-03" in newest.path
    assert tables.newest_file(spark, str(tmp_path), "*.none", folders=2) is None


def test_expired_folders_go_only_when_asked(spark, tmp_path):
    for name in ("dt=2026-01-01", "dt=2026-02-20", "dt=bad", "other"):
        (tmp_path / name).mkdir()
    assert tables.drop_expired(spark, str(tmp_path), "2026-03-01 00:00:00", 30) == ["dt=2026-01-01"]
    assert (tmp_path / "dt=2026-01-01").exists()
    assert tables.drop_expired(spark, str(tmp_path), "2026-03-01", 30, dry_run=False) == ["dt=2026-01-01"]
    assert {p.name for p in tmp_path.iterdir()} == {"dt=2026-02-20", "dt=bad", "other"}


# ---- two streams ------------------------------------------------------------------------------------------------


def test_matched_streams_equal_the_batch(spark, tmp_path):
    anomalies = spark.createDataFrame(
        [("A", 7200, 3, -2.0, "warning", "drop"), ("A", 10_800, 4, -4.0, "critical", "drop"), ("B", 7200, 5, -2.0, "warning", "drop")],
        "region STRING, at BIGINT, aircraft_count BIGINT, z_score DOUBLE, anomaly_status STRING, anomaly_direction STRING",
    ).withColumn("bucket_sk", F.timestamp_seconds("at"))
    events = spark.createDataFrame(
        [("1", "A", 3600, 5.0, -1.0), ("2", "A", 10_800, None, -9.0), ("3", "A", 14_401, 9.0, 0.0), ("4", "C", 7200, 1.0, 1.0), ("5", "A", None, 1.0, 1.0)],
        "global_event_id STRING, nearest_region STRING, at BIGINT, num_mentions DOUBLE, goldstein_scale DOUBLE",
    ).withColumn("event_timestamp", F.timestamp_seconds("at"))
    expected = rows_of(correlation.correlate_with_events(anomalies, events, 60, 60))
    for name, df in (("a", anomalies), ("e", events)):
        for _ in range(2):  # given twice, as a bucket that is scored again
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    one, two = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n)) for n, df in (("a", anomalies), ("e", events)))
    pairs = streams.match_events(one, two, 60, "1 day")
    ingest.drain(streams.store_pairs(pairs, str(tmp_path / "pairs"), str(tmp_path / "m")))
    found = streams.correlated(spark, anomalies, str(tmp_path / "pairs"))
    columns = correlation.correlate_with_events(anomalies, events, 60, 60).columns
    assert rows_of(found, *columns) == expected


def test_state_of_matched_streams_is_bounded(spark, tmp_path):
    for day in range(6):
        rows = [(f"{day}-{i}", "A", (day + 1) * DAY + i * 60, 1.0, 0.0) for i in range(20)]
        df = spark.createDataFrame(rows, "global_event_id STRING, nearest_region STRING, at BIGINT, num_mentions DOUBLE, goldstein_scale DOUBLE")
        df.withColumn("event_timestamp", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
        drops = spark.createDataFrame([("A", (day + 1) * DAY)], "region STRING, at BIGINT").withColumn("bucket_sk", F.timestamp_seconds("at"))
        drops.coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    schemas = {n: spark.read.parquet(str(tmp_path / n)).schema for n in "ae"}
    one, two = (spark.readStream.schema(schemas[n]).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n)) for n in "ae")
    writer = streams.store_pairs(streams.match_events(one, two, 30, "1 hour"), str(tmp_path / "pairs"), str(tmp_path / "m"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(held) <= 2 * 21 + 21
    found = spark.read.parquet(str(tmp_path / "pairs"))
    assert rows_of(found.groupBy(F.unix_seconds("bucket_sk") / DAY).count()) == [(d + 1.0, 20) for d in range(6)]
