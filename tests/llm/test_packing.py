import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from skytally.llm import packing
from skytally.llm.common import table
from skytally.llm.queries import QUERIES
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a, b. c,", 'He said "no", twice., ok', "it's THEY'LL", "İΣΑΣ é É É", "x y z\x1cw",
    "<|endoftext|> a<|startoftext|>", "日本 語", "1,234. 5", "ª º µ ß ÿ", "w" * 300, "a\n\n b\t c",
]


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_layout(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for runs in by.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_ids_by_word_are_those_of_whole_texts():
    words = packing.Words(PATH)
    assert words.encode(ODD) == [np.array(ids, "<u4").tobytes() for ids in plain_ids(ODD)]


def test_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "MOST_CACHED", 0)
    words = packing.Words(PATH)
    assert words.encode(ODD) == [np.array(ids, "<u4").tobytes() for ids in plain_ids(ODD)]


def test_rule_against_a_plain_version():
    """Every gap is tried and the sum computed in full."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 31, 300)
    capacity, gaps, want = 30, [], []
    for size in sizes.tolist():
        def total(b):
            after = [g - size if i == b else g for i, g in enumerate(gaps)]
            return sum(after.count(g) ** 2 for g in set(after) if g > 0)

        fitting = [b for b, g in enumerate(gaps) if g >= size]
        if fitting:
            best = min(fitting, key=lambda b: (total(b), gaps[b]))
            want.append(gaps[best])
            gaps[best] -= size
        else:
            want.append(capacity)
            gaps.append(capacity - size)
    bins, offsets = packing.sum_of_squares(sizes, capacity)
    assert (capacity - offsets).tolist() == want
    assert len(set(bins.tolist())) == len(gaps)


def test_query(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    want = set()
    for d, ids in zip(docs, plain_ids([d.text or "" for d in docs])):
        run = np.array([*ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(run), 4096)):
            cut = run[at : at + 4096]
            want.add((d.doc_id, piece, at, len(cut), zlib.crc32(cut.tobytes())))
    found = QUERIES["op4_packing"](spark, SMALL).collect()
    assert len(found) == len(want)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == want
    tokens = sum(r.length for r in found)
    assert check_layout(found, 4096) <= tokens / 4096 * 1.01 + 2


def test_shards_are_joined_again(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1, 101, 2000))]
    sized = spark.createDataFrame(rows, "doc_id long, length long")
    found = packing.pack(sized, 100, shard_pieces=100).collect()
    assert sorted((r.doc_id, r.length) for r in found) == sorted(rows)
    assert check_layout(found, 100) <= sum(n for _, n in rows) / 100 * 1.05


def test_odd_rows(spark):
    rows = [(1, None, 0), (1, None, 0), (None, "x", 1), (2, "", 2), (3, "word " * 9000, 3)] + [(9, t, 4) for t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece long")
    found = packing.pack_documents(docs, PATH).collect()
    assert sum(r.length for r in found) == sum(len(i) + 1 for i in plain_ids([t or "" for _, t, _ in rows]))
    assert [(r.piece, r.start, r.length) for r in sorted(found, key=lambda r: r.start) if r.doc_id == 3] == [
        (0, 0, 4096), (1, 4096, 4096), (2, 8192, 809),
    ]
    check_layout(found, 4096)
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
