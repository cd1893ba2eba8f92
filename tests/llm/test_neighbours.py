import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from skytally.llm import neighbours
from skytally.llm.common import table
from skytally.llm.queries import QUERIES


def plain(rows, count=20, divisor=20):
    """{query: [(id, score)]} by comparing everything."""
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and any(v) and all(c is not None and math.isfinite(c) for c in v):
            usable.setdefault(i, np.array(v, float))
    out = {}
    for q in usable:
        if q % divisor == 0:
            scores = sorted((-float((usable[q] * v).sum()), i) for i, v in usable.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:count]]
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return sum(len(got.get(q, set()) & {i for i, _ in best}) for q, best in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("data", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, data):
    sf_dir = f"/root/testdata/{data}"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    vectors, want = dict(rows), plain(rows)
    found = QUERIES["op5_multiprobe"](spark, sf_dir).collect()
    assert recall(found, want) >= 0.9
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    for q, best in by.items():
        assert [r.rank for r in best] == list(range(1, 21)) and q not in {r.vec_id for r in best}
        assert [(-r.score, r.vec_id) for r in best] == sorted((-r.score, r.vec_id) for r in best)
        for r in best[::7]:
            assert abs(r.score - float(np.dot(np.array(vectors[q], float), np.array(vectors[r.vec_id], float)))) < 1e-12


def test_probes_come_in_order_of_likelihood():
    rng = np.random.default_rng(1)
    inside = rng.uniform(0, 1, 4)
    found = neighbours.probe_order(inside, 81)

    def cost(chosen):
        return sum((inside[s] if s < 4 else 1 - inside[s - 4]) ** 2 for s in chosen)

    costs = [cost(c) for c in found]
    assert found[0] == () and len(set(map(frozenset, found))) == 81 and costs == sorted(costs)


def test_copies_ties_and_odd_rows(spark, monkeypatch):
    """A third of the rows share a vector; buckets are small enough to be dealt to several tasks."""
    monkeypatch.setattr(neighbours, "HOT", 16)
    monkeypatch.setattr(neighbours, "HELD", 300)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 8))
    rows = [(i, base[i].tolist()) for i in range(120)] + [(200 + i, base[0].tolist()) for i in range(60)] + [(400, (2 * base[0]).tolist())]
    odd = [(500, None), (520, [0.0] * 8), (540, [math.nan] + [1.0] * 7), (560, [math.inf] + [1.0] * 7), (580, [None] + [1.0] * 7), (None, [1.0] * 8)]
    odd += [(600, [1.0] * 3), rows[5], rows[0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, rank int")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, probes=3000).collect()
    want = plain(rows)
    assert recall(found, want) == 1.0
    for q, best in want.items():
        got = [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)]
        assert got == [i for i, _ in best]
    few = neighbours.nearest(df.filter("vec_id < 5"), F.col("vec_id") % 20 == 0, probes=3000).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def nearest(df, **options):
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, **options).collect()
    return {q: [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)] for q in {r.query_id for r in found}}


def test_ties_in_a_bucket_are_settled_by_id(spark):
    """Four hundred different vectors with one score for the query; the smallest ids are due."""
    rng = np.random.default_rng(2)
    rows = [(0, [1.0] + [0.0] * 7)]
    rows += [(1000 + i, [0.5, *(rng.integers(0, 2, 7) / 64 + i / 4096).tolist()]) for i in rng.permutation(400).tolist()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert nearest(df.filter("vec_id = 0 or vec_id >= 1000"))[0] == list(range(1000, 1020))


def test_queries_that_find_too_little_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HOT", 16)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {q: [i for i, _ in best] for q, best in plain(rows).items()}
    assert nearest(df, probes=1, width=0.05) == want
    few = {q: [i for i, _ in best] for q, best in plain(rows[:9]).items()}
    assert nearest(df.filter("vec_id < 9"), probes=1, width=0.05) == few


def test_great_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e10, 0.0]), (2, [-1e150, 3.0]), (3, [2e10, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert nearest(df) == {0: [3, 1, 2]}
