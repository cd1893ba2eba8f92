import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from skytally.llm import bpe
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "x\n y", "\x00\x01a'll  ▁ ▁x", "<|endoftext|> İΣ é", "it's  they'll",
    "日本語 テキスト ", "a" * 3000, "#" * 300, " x  y", "tab\t\tend\t", "é \U0001f600\U0001f600",
]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_ids_are_those_of_the_library(codec, library):
    assert codec.encode(ODD) == [packed(library.encode_ordinary(t)) for t in ODD]
    assert codec.encode(ODD) == [packed(library.encode_ordinary(t)) for t in ODD]  # now from the cache


def test_every_token_is_reached_by_the_models_own_merges(codec):
    pieces = ["".join(codec.chars[b] for b in t) for t in codec.tokens]
    assert codec.model.encode(pieces) == [[i] for i in range(len(pieces))]


def test_full_cache(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CACHED", 0)
    text = "words never seen beforehand qzx and again qzx"
    assert codec.encode([text, text]) == [packed(library.encode_ordinary(text))] * 2


def test_query(spark, library):
    want = set()
    for d in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        ids = library.encode_ordinary(d.text or "")
        digest = hashlib.sha256((d.text or "").encode()).hexdigest()
        want.add((d.doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), digest))
    assert {tuple(r) for r in QUERIES["op7_byte_bpe"](spark, SMALL).collect()} == want


def test_odd_rows(spark, library):
    rows = [(1, None, 7), (None, "a b", 8), (2, "x", 9), (2, "x", 9)] + [(10 + i, t, 0) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = bpe.encode_decode(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in found) == sorted((i or 0, (t or "").encode()) for i, t, _ in rows)
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    assert bpe.encode_decode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
