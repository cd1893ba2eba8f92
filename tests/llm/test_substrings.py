import hashlib
import random
from collections import Counter

import pytest
from skytally.llm import substrings
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(rows, length=200):
    """(key, n_bytes, n_removed, n_spans, sha256) by looking at every string."""
    texts = [(key, (text or "").encode()) for key, text in rows]
    often = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for key, b in texts:
        gone, end = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            if often[b[i : i + length]] > 1:
                gone[max(i, end) : i + length] = b"\x01" * (i + length - max(i, end))
                end = i + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert found(QUERIES["op1_suffix_dedup"](spark, SMALL)) == plain([tuple(d) for d in docs])


def words(rng, n):
    return " ".join(rng.choice(["ab", "cde", "é", "fghij", "k"]) for _ in range(n))


def odd_texts():
    rng = random.Random(4)
    shared = [words(rng, 200) for _ in range(3)]
    texts = [None, "", "short", "a" * 199, "b" * 200, "b" * 200, "c" * 201, "ab" * 400, "xyz" * 100]
    texts += [words(rng, 30) + shared[i % 3][i : 250 + 3 * i] + words(rng, 40) for i in range(40)]
    texts += [shared[0][:199], shared[0][:200], shared[1] + shared[1], "é" * 300]
    texts += [shared[2][:i] + "#" + shared[2][i:] for i in range(0, 500, 37)]
    return texts


def test_odd_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(odd_texts())]
    rows += [rows[20], (None, rows[21][1], 2), (3, rows[22][1], 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long")
    assert found(substrings.remove_repeats(docs)) == plain([r[:2] for r in rows])
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
    kept = substrings.remove_repeats(docs, texts=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in kept)


@pytest.mark.parametrize("length", [128, 253])
def test_other_lengths(spark, length):
    rows = list(enumerate(odd_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substrings.remove_repeats(docs, length)) == plain(rows, length)


def test_long_texts_and_small_blocks(spark, monkeypatch):
    """Texts far longer than a segment, and blocks so small that equal strings meet only after the shuffle."""
    monkeypatch.setattr(substrings, "SLICE_BYTES", 700)
    monkeypatch.setattr(substrings, "DEAL_KEYS", 20)
    rng = random.Random(6)
    shared = words(rng, 400)
    rows = [(i, words(rng, 900) + shared[i:] + words(rng, 900)) for i in range(6)] + list(enumerate(odd_texts(), 10))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(substrings.remove_repeats(docs)) == plain(rows)
