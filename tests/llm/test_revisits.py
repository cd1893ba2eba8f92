import random

import pytest
from compare import connect, difference
from skytally.llm import revisits
from skytally.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"
SCHEMA = "record_id long, url string, at long, kind string, headers map<string,string>, digest string, page string"


def test_query_against_sql(spark):
    assert difference(QUERIES["op6_revisits"](spark, DATA), connect(DATA), ORACLES["op6_revisits"]) is None


def test_every_outcome_occurs(spark):
    found = {r.outcome for r in QUERIES["op6_revisits"](spark, DATA).collect()}
    assert found == {"resolved", "validator_mismatch", "no_validator", "no_earlier_response"}


@pytest.mark.parametrize("chunk", [5, 20_000])
def test_hot_page_against_brute_force(spark, monkeypatch, chunk):
    """A third of the captures are of one page; times tie."""
    monkeypatch.setattr(revisits, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    rows = [(i, rng.choice(["hot", "hot", f"p{rng.randrange(30)}"]), rng.randrange(300), rng.random() < 0.7) for i in range(900)]
    found = revisits.latest_earlier(spark.createDataFrame(rows, "record_id long, page string, at long, is_revisit boolean"))
    want = {}
    for i, page, at, again in rows:
        if again:
            earlier = [(t, j) for j, p, t, r in rows if p == page and t < at and not r]
            want[i] = max(earlier)[1] if earlier else None
    assert {r.revisit_id: r.original_id for r in found.collect()} == want


def test_headers_and_odd_rows(spark):
    url = "HTTPS://www.Example.org:443/a/?b=2&utm_source=x&a=1#top"
    full = {"ETag": 'W/"1"', "Content-Type": "text/html", "Content-Length": "9", "X": "old"}
    rows = [
        (1, url, 10, "response", full, "d1", "x"),
        (2, "http://example.org/a?a=1&b=2", 20, "revisit", {"etag": '"1"', "content-length": "0", "x": "new", "Age": "3", "Gone": None}, None, "x"),
        (3, url, 10, "revisit", {}, None, "x"),  # an equal time is not earlier
        (4, url, 30, "revisit", None, None, "x"),
        (5, None, 30, "revisit", {}, None, "x"),
        (6, url, None, "revisit", {"ETag": '"1"'}, None, "x"),
        (7, url, 40, None, {"etag": '"2"'}, "d7", "x"),
        (8, url, 50, "revisit", {"etag": '"1"'}, None, "x"),
        (8, url, 50, "revisit", {"etag": '"1"'}, None, "x"),
        (None, url, 60, "revisit", {}, None, "x"),
        (9, "u" * 100_000, 5, "revisit", {}, None, "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    every = revisits.resolve(df).collect()
    found = {r.revisit_id: r for r in every}
    assert len(found) == len(every)
    assert {i: (r.original_id, r.outcome) for i, r in found.items()} == {
        2: (1, "resolved"), 3: (None, "no_earlier_response"), 4: (1, "no_validator"), 5: (None, "no_earlier_response"),
        6: (None, "no_earlier_response"), 8: (7, "validator_mismatch"), 9: (None, "no_earlier_response"),
    }
    assert found[2].page == "example.org/a?a=1&b=2" and found[2].digest == "d1" and found[4].headers is None
    assert found[2].headers == {"etag": '"1"', "content-type": "text/html", "content-length": "9", "x": "new", "age": "3"}
    assert revisits.resolve(df.limit(0)).count() == 0


def test_records_given_twice_are_one(spark):
    """A response and a revisit, each twice, once with other headers: one row with one outcome."""
    rows = [(1, "http://a/", 10, "response", {"ETag": "1", "B": "2"}, "d", "x")] * 2 + [(2, "http://a/", 20, "revisit", {"ETag": "1"}, None, "x")] * 2
    rows += [(1, "http://a/", 10, "response", {"ETag": "9"}, "d", "x"), (2, "http://a/", 20, "revisit", {"ETag": "7"}, None, "x")]
    found = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.revisit_id, r.original_id) for r in found] == [(2, 1)]
