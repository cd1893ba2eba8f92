import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from skytally.llm import queries, resampling
from skytally.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(A_TO_Z))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(docs, target, buckets=10_000, percent=25, least=20):
    """(doc_id, text) pairs and texts to the rows of the operator, one feature after the other."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for feature in features(text)[1]:
                counts[bucket(feature)] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out, pool = {}, []
    for key, text in docs:
        n, found = features(text)
        weight = sum(gains[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[key] = [key, len(found), weight, score, None]
        if n >= least:
            pool.append((-score, key))
    for rank, (_, key) in enumerate(sorted(pool)[: percent * len(pool) // 100], 1):
        out[key][4] = rank
    return sorted(map(tuple, out.values()))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_the_plain_version(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    found = queries.QUERIES["op11_resampling"](spark, SMALL)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in found.schema.fields} == {"bigint"}
    assert rows(found) == plain(docs, target)


ODD = [
    (1, None),
    (2, ""),
    (3, "  \n\n ,.;  \n"),
    (4, "ONE two\nThree\n\n  four2 Ünï-ÇÖDÉ \x7f x\r\ny"),
    (5, "ÀÉ éà 漢字 漢字\n漢字"),
    (6, "a" * 70 + " " + "b" * 65 + "\n" + "c" * 500 + " d"),
    (7, "\n".join(["same line again"] * 60)),
    (8, "word " * 30),
    (9, "word " * 30),
    (10, "it's 3.14 e.g. naïve–dash"),
    (11, " ".join(f"w{i % 7}" for i in range(40)) + "\nlast"),
]


@pytest.mark.parametrize("target", [["word word x y", None, ""], [], [None]])
def test_odd_texts(spark, target):
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in ODD], "doc_id long, text string, line string, row int")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(docs, bench, percent=60, buckets=101)
    assert rows(found) == plain(ODD, target, buckets=101, percent=60)


def test_repeated_rows_and_null_keys(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None), (2, None)], "doc_id long, text string")
    found = resampling.resample(docs, docs, percent=100).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]
    assert len(found) == 5
    assert all(r["n_features"] == (0 if r["doc_id"] == 2 else 49) for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(docs, docs).collect() == []


def test_ranks_run_over_all_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 100).alias("v"))
    found = {r["k"]: r["rank"] for r in resampling.rank_all(df, [F.desc("v"), F.asc("k")]).collect()}
    order = sorted(range(1000), key=lambda k: (-(k * 7919 % 100), k))
    assert found == {k: i + 1 for i, k in enumerate(order)}


def test_checksums():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcé9\n -"), 300)) for _ in range(5)] + ["x" * 200 + " " + "y" * 64 + " " + "z" * 65]
    words = resampling.Words(pa.array(texts))
    all_words = [w for t in texts for w in WORD.findall(t)]
    assert words.crc.tolist() == [zlib.crc32(w.encode()) for w in all_words]
    first = np.sort(np.concatenate([words.pairs(False), words.pairs(True)]))
    pairs = [f"{a} {b}" for t in texts for a, b in zip(WORD.findall(t), WORD.findall(t)[1:])]
    assert words.pair_checksums(first).tolist() == [zlib.crc32(p.encode()) for p in pairs]
