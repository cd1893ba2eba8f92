import numpy as np
import pytest
import xxhash
from skytally.llm import common, simhash
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=4):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_query_against_brute_force(spark):
    docs = sorted(table(spark, SMALL, "documents").select("doc_id", "text").collect())
    fps = [plain_fingerprint(d.text) for d in docs]
    roots = plain_components(fps)
    want = {(d.doc_id, f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, roots)}
    assert {tuple(r) for r in QUERIES["op8_simhash"](spark, SMALL).collect()} == want


def test_cells_lose_no_pair():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    for flips in range(5):
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, flips, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(bit)
        for width in (1, 2, 4):
            pairs = zip(simhash.cells(a, 4, width), simhash.cells(b, 4, width))
            assert all(set(x) & set(y) for x, y in pairs)


def test_chains_and_dense_groups(spark):
    """A chain of fingerprints, four bits a step, and all words of weight two: each is one component."""
    chain = [(1 << (4 * k)) - 1 for k in range(15)]
    dense = [(1 << 63) | (1 << i) | (1 << j) | (0xFFFF << 40) for i in range(20) for j in range(i)]
    signed = [x - (1 << 64) if x >> 63 else x for x in chain + dense]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, 2)
    roots = {r.node: r.root for r in simhash.components(found).collect()}
    assert len({roots[x] for x in signed[: len(chain)]}) == 1
    assert len({roots[x] for x in signed[len(chain) :]}) == 1


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (3, " \n\t", 2), (4, "one", 3), (4, "one", 4), (None, "ONE", 5), (5, "é" * 50000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    found = sorted(simhash.near_duplicates(docs).collect(), key=repr)
    by = {(r.doc_id, r.component_id) for r in found}
    assert len(found) == len(rows)
    assert by == {(1, 1), (2, 1), (3, 1), (4, 4), (None, 4), (5, 5)}
    assert {r.fp for r in found if r.component_id == 1} == {0}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words", [1, 3, 4, 5, 70000])
def test_lengths(words):
    text = " ".join(f"W{i % 97}" for i in range(words))
    assert simhash.fingerprint(text, 4) % (1 << 64) == plain_fingerprint(text)


def test_only_what_may_go_is_dealt(spark):
    rows = spark.range(20000).selectExpr("xxhash64(id) AS k", "id")
    some = rows.filter("id % 50 = 0").select("k")
    rest, others = common.parted(rows, some, "k")
    assert others.join(some, "k", "left_semi").count() == 400 and rest.join(some, "k", "left_semi").count() == 0
    assert rest.count() + others.count() == 20000 and others.count() < 3000
    rest, others = common.parted(rows, some.limit(0), "k")
    assert rest.count() == 20000 and others.count() == 0


def test_keep_first_of_copies(spark):
    same, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, same, "a"), (1, same, "b"), (1, same, "b"), (None, same, "c"), (7, other, "d"), (None, None, "e"), (None, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sorted(map(tuple, simhash.keep_first(docs, shingle=4).collect()), key=repr)
    assert found[0] == (1, same, "b") and found[1] == (7, other, "d") and len(found) == 3 and found[2][2] in "ef"
