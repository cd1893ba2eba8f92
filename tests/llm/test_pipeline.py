import re

import corpus_pipeline
import numpy as np
import pytest
from skytally.llm import simhash
from skytally.llm.common import stored, table
from test_packing import check_layout, plain_ids
from test_simhash import plain_components, plain_fingerprint

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, DATA, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DATA), name))
    return [df.collect() for df in out]


def test_columns(outputs):
    for rows in outputs[1:-1]:
        assert rows[0].asDict().keys() == outputs[0][0].asDict().keys()


def test_language_keeps_clean_documents(outputs):
    kept = {r.doc_id for r in outputs[1]}
    gone = [r for r in outputs[0] if r.doc_id not in kept]
    assert all(not any(c.isalpha() for c in r.text or "") for r in gone) or len(gone) <= 0.01 * len(outputs[0])


def test_one_of_each_group_stays(outputs):
    rows = sorted(outputs[1], key=lambda r: r.doc_id)
    roots = plain_components([plain_fingerprint(r.text, 4) for r in rows])
    assert {r.doc_id for r in outputs[2]} == {rows[i].doc_id for i in set(roots)}
    assert {r.doc_id: r.text for r in outputs[2]}.items() <= {r.doc_id: r.text for r in rows}.items()


def test_no_long_passage_is_left_twice(outputs):
    seen, twice = {}, 0
    for r in sorted(outputs[3], key=lambda r: r.doc_id):
        words = r.text.lower().split()
        for i in range(len(words) - 59):
            if seen.setdefault(tuple(words[i : i + 60]), r.doc_id) != r.doc_id:
                twice += 1
    assert twice == 0
    assert all(r.n_chars == len(r.text) for r in outputs[3])


def test_secrets_are_masked_and_nothing_else_changes(outputs):
    before = {r.doc_id: r.text for r in outputs[3]}
    assert {r.doc_id for r in outputs[4]} == set(before)
    secret = re.compile(r"(?i)(token = \"?|password=)[0-9a-f]{16,}|AKIA[A-Z0-9]{16}")
    for r in outputs[4]:
        assert not secret.search(r.text)
        assert r.text == before[r.doc_id] or "[SECRET]" in r.text


def test_packing_holds_every_token(outputs):
    check_layout(outputs[5], 4096)
    assert sum(r.length for r in outputs[5]) == sum(len(i) + 1 for i in plain_ids([r.text for r in outputs[4]]))


def test_run_gives_the_last_stage(spark, outputs):
    found = corpus_pipeline.run(spark, DATA).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in outputs[5])


def test_keep_first_on_odd_rows(spark):
    rows = [(4, "a b c d e f", 1), (4, "a b c d e f", 1), (2, "A b c d e f", 2), (None, "a b c d e f", 3), (7, None, 4), (8, "", 5), (9, "other words", 6)]
    rows += [(4, "quite another text of words", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    kept = sorted(((r.doc_id, r.fp) for r in simhash.keep_first(docs).collect()), key=str)
    assert kept == [(2, 2), (4, 7), (7, 4), (9, 6)]
    assert simhash.keep_first(docs.filter("doc_id = 4 and fp = 1")).count() == 1
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_stages_on_an_empty_table(spark):
    docs = table(spark, DATA, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), name)
        assert docs.count() == 0


def test_stages_on_nulls(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "the of and " * 30, "en", "s", 5), (1, "the of and " * 30, "en", "s", 5)], table(spark, DATA, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), name)
    assert np.unique([r.doc_id for r in docs.collect()]).tolist() == [1]
