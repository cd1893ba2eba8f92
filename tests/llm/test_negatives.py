import math

import numpy as np
import pytest
from compare import connect, difference
from conftest import SMALL
from pyspark.sql import functions as F
from skytally.llm import negatives, queries

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, every=100, n_positives=5, n_negatives=10):
    """The rows of the operator, pair by pair in whole numbers."""
    good = {}
    for key, label, vector in rows:
        if None in (key, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good[key, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)] = None
    good = list(good)
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in good if b[0] != a[0] and len(b[2]) == len(a[2]))
        for score, key, _ in [s for s in scored if s[2] == a[1]][:n_positives]:
            found = [s for s in scored if s[2] != a[1] and 30 * -score <= 100 * -s[0] <= 90 * -score][:n_negatives]
            out += [(a[0], key, rank, s[1], -score, -s[0]) for rank, s in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")).withColumn("anchor", F.lit(0))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect())


def test_query_equals_sql(spark):
    found = queries.QUERIES["op12_negatives"](spark, SMALL)
    assert difference(found, connect(SMALL), queries.ORACLES["op12_negatives"]) is None


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_blocks_and_groups_change_nothing(spark, monkeypatch, block_rows):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(negatives, "GROUP_BYTES", 8 * 12)
    rng = np.random.default_rng(block_rows)
    rows = [(i, int(rng.integers(3)), (rng.normal(size=12) + 0.5).tolist()) for i in list(range(0, 60)) + [100, 200, 300]]
    expected = plain(rows)
    assert expected and mined(spark, rows) == expected


def test_ties_repeats_and_rows_without_part(spark):
    same = [1.0, 0.5, 0.25]
    rows = [(i, 1, same) for i in range(0, 40)] + [(i, 2, [x * 0.5 for x in same]) for i in range(50, 90)]
    rows += [(50, 2, [x * 0.5 for x in same]), (0, 1, same)]  # given twice
    rows += [(200, None, same), (300, 1, None), (400, 1, [1.0, None, 0.0]), (None, 2, same), (95, 2, [math.nan, 0.0, 0.0]), (96, 2, [math.inf, 0.0, 0.0])]
    rows += [(500, 3, [1.0]), (501, 3, [1.0]), (502, 4, [0.5]), (600, 5, []), (601, 5, []), (602, 6, [])]  # other lengths
    expected = plain(rows)
    assert [r[3] for r in expected if r[0] == 0][:10] == list(range(50, 60))
    assert (600, 601, 1, 602, 0, 0) in expected
    assert mined(spark, rows) == expected


def test_one_id_with_two_vectors(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [0.5, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.4, 0.0]), (2, 3, [0.4, 0.0])]
    assert mined(spark, rows) == plain(rows)


def test_great_components_are_exact(spark):
    rows = [(0, 1, [6e6, 1.0, -4e6]), (1, 1, [6e6, 2.0, -4e6]), (2, 2, [3e6, 1.0, -2e6]), (3, 2, [3e6, 1.5, -2e6]), (4, 2, [1.0, 1.0, 1.0])]
    expected = plain(rows)
    assert expected and mined(spark, rows) == expected
    mined(spark, [*rows, (5, 2, [3e38, 0.0, 0.0]), (6, 1, [3e38, 0.0, 0.0])])  # no number of 64 bits, and no failure


def test_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0]), (2, 2, [1.0])]) == []  # an anchor without a positive


def test_the_scan_reads_few_columns_of_most_rows(monkeypatch):
    """Bounds leave only candidates near the window once the large components are read."""
    rng = np.random.default_rng(1)
    weights = 0.7 ** np.arange(64)
    matrix = np.floor(256 * rng.normal(size=(2000, 64)) * weights)
    block = negatives.Block(np.arange(2000), np.zeros(2000, np.int64), matrix)
    left = []

    def shrink(lower, upper):
        assert (lower <= upper).all()
        left.append(len(lower))
        return upper >= negatives._kth(lower, 5)

    rows, scores = block.scan(matrix[7], np.arange(2000), shrink)
    exact = matrix @ matrix[7]
    assert (exact[rows] == scores).all() and set(np.argsort(-exact)[:5]) <= set(rows.tolist())
    assert left[0] == 2000 and left[-1] < 50
