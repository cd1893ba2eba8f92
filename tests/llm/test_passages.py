import random
import time
from collections import defaultdict

import numpy as np
from skytally.llm import passages
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def split(text):
    return (text or "").encode().lower().split()


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            up = row[j]
            row[j], diagonal = (diagonal + 1 if x == y else max(row[j - 1], up)), up
    return row[-1]


def test_chain_against_all_pairs():
    rng = np.random.default_rng(8)
    for n in (1, 5, 40, 120):
        at, to = rng.integers(0, 60, n), rng.integers(0, 60, n)
        found = passages.chain(at, to)
        assert sorted(i for c in found for i in c) == list(range(n))
        for c in found:
            assert all(at[i] < at[j] and to[i] < to[j] for i, j in zip(c, c[1:]))
        order = np.lexsort((to, at))
        best = {}
        for i in order:
            before = [best[j] - passages.GAP_COST * (at[i] - at[j] + to[i] - to[j]) for j in best if at[j] < at[i] and to[j] < to[i]]
            best[i] = passages.K + max([0.0, *before])
        first = found[0]
        gaps = sum(at[j] - at[i] + to[j] - to[i] for i, j in zip(first, first[1:]))
        assert abs(passages.K * len(first) - passages.GAP_COST * gaps - max(best.values())) < 1e-9


def test_words():
    text = "Ab  cd\n\té É\x0bz " + "q" * 50 + " "
    for size in (1 << 20, 7):
        passages.SLICE_BYTES, kept = size, passages.SLICE_BYTES
        try:
            data = np.frombuffer((text + "ab x" + "" + "ab").encode(), np.uint8)
            n = len(text.encode())
            hashes, owner, first, behind = passages.words_of(data, np.array([0, n, n + 4, n + 4, n + 6]))
        finally:
            passages.SLICE_BYTES = kept
        spelled = [data[a:b].tobytes() for a, b in zip(first, behind)]
        assert spelled == text.encode().split() + [b"ab", b"x", b"ab"]
        assert owner.tolist() == [0] * 6 + [1, 1, 3]
        assert hashes[0] == hashes[6] == hashes[8] and len(set(hashes.tolist())) == 7


def test_exact_windows_of_real_documents(spark):
    """Each run of 50 words that an earlier document has is reported but for a few words at its ends, and each
    report is right by a full alignment."""
    docs = {d.doc_id: split(d.text) for d in table(spark, DATA, "documents").collect()}
    first, wanted = {}, defaultdict(set)
    for i in sorted(docs):
        for k in range(len(docs[i]) - 49):
            if first.setdefault(tuple(docs[i][k : k + 50]), i) != i:
                wanted[i].update(range(k, k + 50))
    found = QUERIES["op10_passages"](spark, DATA).collect()
    got = defaultdict(set)
    for r in found:
        got[r.doc_id].update(range(r.begin_word, r.end_word))
        assert r.other < r.doc_id and r.end_word - r.begin_word >= 50 and r.similarity >= 0.8
        a, b = docs[r.doc_id][r.begin_word : r.end_word], docs[r.other][r.other_begin : r.other_end]
        assert abs(common(a, b) / max(len(a), len(b)) - r.similarity) < 0.03
    assert set(wanted) <= set(got)
    missed = sum(len(words - got[i]) for i, words in wanted.items())
    assert missed <= 0.005 * sum(map(len, wanted.values()))


def made(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_planted_fuzzy_passages_and_clean_texts(spark):
    rng = random.Random(3)
    passage = made(rng, 90)
    rows, planted = [], set()
    for i in range(60):
        body = made(rng, 150)
        if i % 2:
            changed = list(passage)
            for at in range(i % 23, 90, 30):
                changed[at] = f"x{i}"
            if i % 3 == 0:
                del changed[40]
            body[70:70] = changed
            planted.add(i)
        rows.append((i, " ".join(body), "s"))
    found = passages.passages(spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(3)).collect()
    assert {r.doc_id for r in found} == planted - {1}
    assert all(55 <= r.begin_word <= 85 and 140 <= r.end_word <= 170 for r in found)


def test_odd_rows(spark):
    rng = random.Random(5)
    text = " ".join(made(rng, 80))
    long = " ".join(made(rng, 30000))
    rows = [(1, text, 0), (1, text, 0), (2, text, 0), (None, text.upper(), 0), (3, None, 0), (4, "", 0), (5, " \n", 0), (6, "a b", 0)]
    rows += [(7, "x " * 40000, 0), (8, "x " * 300, 0), (9, long, 0), (10, long + " " + text, 0), (11, "q" * 100000, 0), (12, text + "\n" + text, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, begin_word int")
    found = {(r.doc_id, r.begin_word, r.end_word) for r in passages.passages(docs).collect()}
    assert {(2, 0, 80), (None, 0, 80), (10, 0, 30000), (10, 30000, 30080), (12, 0, 80), (12, 80, 160)} <= found
    assert {f[0] for f in found} <= {2, None, 8, 10, 12}
    kept = {r.doc_id: r.text for r in passages.cut_passages(docs).collect()}
    assert set(kept) == {1, 3, 4, 5, 6, 7, 8, 9, 11} or set(kept) == {1, 3, 4, 5, 6, 7, 9, 11}
    assert kept[1] == text and kept[9] == long and kept[3] is None
    assert passages.passages(docs.limit(0)).count() == 0 and passages.cut_passages(docs.limit(0)).count() == 0


def test_cut_keeps_the_rest(spark):
    rng = random.Random(9)
    passage, before, after = (" ".join(made(rng, n)) for n in (70, 20, 30))
    docs = spark.createDataFrame([(1, passage), (2, f"{before}\n{passage}\n\n{after}")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in passages.cut_passages(docs).collect()} == {1: passage, 2: f"{before}\n{after}"}


def test_exact_passage_beside_a_reworked_one():
    """60 exact words and 100 of which 60 percent agree are one chain of similarity 0.75; the exact words are a passage."""
    rng = random.Random(11)
    a = np.array([rng.randrange(1, 60000) for _ in range(160)], np.uint16)
    b = a.copy()
    for start in range(60, 160, 10):
        b[start : start + 4] ^= np.uint16(1)
    at = np.array([*range(0, 56, 4), *range(64, 160, 10)])
    found = passages.align(a, b, at, at)
    assert found and max(f[1] - f[0] for f in found) >= 60
    for x0, x1, y0, y1, similarity in found:
        assert x1 - x0 >= 50 and similarity >= 0.8
        assert abs(common(a[x0:x1].tolist(), b[y0:y1].tolist()) / max(x1 - x0, y1 - y0) - similarity) < 0.03
    assert min(f[0] for f in found) == 0


def test_seeds_that_lead_to_different_texts(spark):
    """The halves of a passage have first texts of their own; the whole is first in the third text and again in all later ones."""
    rng = random.Random(13)
    passage, other = made(rng, 80), made(rng, 54)
    rows = [(1, made(rng, 30) + passage[:40] + made(rng, 30)), (2, made(rng, 30) + passage[40:] + made(rng, 30))]
    rows += [(i, made(rng, 30 + i) + passage + made(rng, 40)) for i in range(3, 30)]
    rows += [(30, made(rng, 20) + other[:38] + made(rng, 20)), (31, made(rng, 20) + other[16:] + made(rng, 20))]
    rows += [(i, made(rng, 10 + i) + other + made(rng, 10)) for i in range(32, 36)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    for parts in (1, 4):
        found = passages.passages(docs.repartition(parts)).collect()
        assert {r.doc_id for r in found} == {*range(4, 30), *range(33, 36)}
        got = {(r.doc_id, r.begin_word, r.end_word) for r in found}
        for i in range(4, 30):
            assert any(d == i and a <= 30 + i + 1 and b >= 110 + i - 1 for d, a, b in got)


def test_common_words_equal_the_table():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(0, 80)).astype(np.uint16) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a.tolist():
            before = row[:]
            for j, y in enumerate(b.tolist(), 1):
                row[j] = before[j - 1] + 1 if x == y else max(row[j - 1], before[j])
        assert passages.same_words(a, b) == row[-1]


def test_matches_on_a_diagonal_are_one_chain(monkeypatch):
    rng = np.random.default_rng(9)
    for _ in range(100):
        at = np.cumsum(rng.integers(1, 30, rng.integers(1, 40)))
        to = at + 7
        if rng.random() < 0.3:
            to = np.sort(at + rng.integers(0, 3, len(at)))
        mixed = rng.permutation(len(at))
        quick = passages.chain(at[mixed], to[mixed])
        with monkeypatch.context() as m:
            m.setattr(passages, "_straight", lambda *_: False)
            assert quick == passages.chain(at[mixed], to[mixed])


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_what_steps_have_shuffled_goes_with_them(spark):
    rng = random.Random(11)
    words = [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(12)]
    words[7][40:140] = words[2][60:160]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    before = shuffled_files(spark)
    found = passages.passages(docs)
    for _ in range(40):
        left = {f.split("_")[1] for f in shuffled_files(spark) - before}
        if len(left) <= 1:  # of the sum of sizes
            break
        time.sleep(0.25)
    assert len(left) <= 1
    assert [(r.doc_id, r.other) for r in found.collect()] == [(7, 2)]


def test_orders_and_lookups_are_those_of_plain_versions():
    rng = np.random.default_rng(5)
    for spread in (3, 50, 10**6):
        keys, ids, rids, places = (rng.integers(0, spread, 500) for _ in range(4))
        rids = rids - spread // 2
        columns = np.stack([keys, ids, rids, places])
        assert (columns[:, passages._by_key(*columns)] == columns[:, np.lexsort((places, rids, ids, keys))]).all()
        part = keys % 7
        assert (passages._by_place(part, rids, places) == np.lexsort((places, rids, part))).all()
        known, wanted = np.sort(places), rng.integers(0, spread, 100)
        last = {p: i for i, p in enumerate(known.tolist())}
        index, there = passages._last_at(known, wanted)
        assert [i if t else None for i, t in zip(index.tolist(), there.tolist())] == [last.get(w) for w in wanted.tolist()]


def test_texts_are_dealt_once(spark):
    """Later joins by rid do not move the texts, and how the input lies has no part in the result."""
    rng = random.Random(3)
    passage = made(rng, 90)
    rows = [(i, " ".join(made(rng, 20 + i) + passage[i % 3 : 60 + i] + made(rng, 30))) for i in range(30)]
    docs = spark.createDataFrame(rows + rows[:4] + [(None, rows[0][1]), (99, None)], "doc_id long, text string")
    numbers, whole = passages._numbered(passages._keyed(docs, "doc_id", "text"), 4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = whole.join(numbers.groupBy("rid").count(), "rid", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not [x for x in plan.splitlines() if "Exchange" in x and x.startswith("   :")] and "Bucketed: true" in plan
    assert whole.count() == len(rows) + 6
    order = [(r.id, r.rid) for r in numbers.orderBy("no").collect()]
    assert order == sorted(set(order)) and len(order) == len(rows) + 2
    found = [sorted(map(tuple, passages.passages(docs.repartition(n)).collect()), key=repr) for n in (1, 4)]
    assert found[0] == found[1] and found[0]


def plain_places(first, second):
    rows = [[0] * (len(second) + 1)]
    for x in first:
        row = [0]
        for j, y in enumerate(second, 1):
            row.append(rows[-1][j - 1] + 1 if x == y else max(row[-1], rows[-1][j]))
        rows.append(row)
    out, i, j = [], len(first), len(second)
    while i and j:
        if first[i - 1] == second[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def reworked(rng, n, alike):
    """Words, a version of them in which so many of ten stay (others are changed, left out or put in), and the places of equal seeds."""
    a, b, at, to = [], [], [], []
    while len(a) < n:
        at.append(len(a))
        to.append(len(b))
        same = rng.integers(0, 60000, passages.K).tolist()
        a += same
        b += same
        for _ in range(int(rng.integers(0, 9))):
            x = int(rng.integers(0, 60000))
            kind = rng.random() * 10 if rng.random() * 10 >= alike else 10
            a += [x] * (kind > 2)
            b += [x] if kind == 10 else [x ^ 1] if kind > 4 else [x ^ 1, x] if kind <= 2 else []
    return a, b, at, to


def test_places_in_common_are_those_of_the_table():
    rng = np.random.default_rng(21)
    for _ in range(300):
        a, b = (rng.integers(0, 5, rng.integers(0, 70)).tolist() for _ in range(2))
        if rng.random() < 0.3:
            b = a[: len(a) // 2] + b + a[len(a) // 2 :]
        assert passages.common_places(a, b) == plain_places(a, b)


def test_chains_that_cannot_hold_a_passage_are_not_searched(monkeypatch):
    """The search for parts runs only where the gaps leave room for one; elsewhere it would find nothing."""
    rng = np.random.default_rng(22)
    search, verdicts = passages.best_parts, []
    monkeypatch.setattr(passages, "best_parts", lambda *x: [])
    ask = passages._may_have_parts
    rows = [reworked(rng, int(rng.integers(60, 400)), alike) for alike in (1, 4, 5, 6, 7, 8) for _ in range(60)]
    for a, b, at, to in rows:
        arrays = [np.array(a, np.uint16), np.array(b, np.uint16), np.array(at), np.array(to)]
        calls = []
        with monkeypatch.context() as m:
            m.setattr(passages, "_may_have_parts", lambda gaps, calls=calls: calls.append([ask(gaps)]) or True)
            m.setattr(passages, "best_parts", lambda *x, calls=calls: calls[-1].append(search(*x)) or calls[-1][1])
            whole = passages.align(*arrays)
        with monkeypatch.context() as m:
            m.setattr(passages, "best_parts", search)
            assert passages.align(*arrays) == whole
        assert all(may or not parts for may, parts in calls)
        verdicts += [(may, bool(parts)) for may, parts in calls]
    assert {(False, False), (True, True)} <= set(verdicts)
    changed = np.arange(300, dtype=np.uint16)
    places = np.arange(0, 300, 10)
    other = changed.copy()
    other[(changed % 10 >= 5) & (changed % 10 < 9)] += 1000
    monkeypatch.setattr(passages, "best_parts", lambda *x: 1 / 0)  # 60 percent alike everywhere: not searched
    assert passages.align(changed, other, places, places) == []


def test_chains_over_too_few_words_are_left_out():
    rng = np.random.default_rng(23)
    for n in (1, 7, 60, 200):
        for spread in (12, 300):
            at, to = rng.integers(0, spread, n), rng.integers(0, spread, n)
            whole = passages.chain(at, to)
            assert passages.chain(at, to, 30) == [c for c in whole if at[c[-1]] + passages.K - at[c[0]] >= 30]


def test_orders_by_leading_bits():
    rng = np.random.default_rng(24)
    for n in (0, 1, 50, 5000):
        keys = rng.integers(0, 1 << 62, n).astype(np.uint64)
        if n:
            keys[rng.integers(0, n, n // 3)] = keys[0]
            keys[rng.integers(0, n, n // 3)] = keys[0] ^ rng.integers(0, 4, n // 3).astype(np.uint64)  # differ in the last bits only
        order, own = passages._order(keys)
        assert sorted(order.tolist()) == list(range(n)) and (own == np.sort(keys)).all() and (keys[order] == own).all()
    for low, high in ((-5, 5), (-(1 << 62), 1 << 62)):
        values = rng.integers(low, high, 700)
        found, wanted = passages._ranked(values), np.unique(values, return_inverse=True)
        assert all((f == w).all() for f, w in zip(found, wanted))


def test_words_longer_than_the_table_of_hashes():
    texts = ["q" * n for n in (1, 63, 64, 65, 300)] + ["Q" * 300, "q" * 299 + "r", "a" + " " * 500 + "b"]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    hashes, _, _, _ = passages.words_of(data, np.array([0, len(data)]))
    assert len(hashes) == 9 and len(set(hashes.tolist())) == 8 and hashes[4] == hashes[5]
    for text, value in zip(texts, hashes.tolist()):
        own = np.frombuffer(text.encode(), np.uint8)
        whole = passages._byte_hashes(own, np.arange(len(own))).sum(keepdims=True) * passages.phrases.FACTORS[2]
        assert len(text.split()) > 1 or whole.tolist() == [value]


def test_texts_without_a_seed(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string").coalesce(1)
    assert passages.passages(docs).count() == 0 and passages.cut_passages(docs).count() == 3
