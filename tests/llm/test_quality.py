import re
from collections import Counter

import duckdb
import numpy as np
from skytally.llm import quality
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", *quality.COUNTS, "base_failed"]


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def plain_verdicts(rows):
    """Group, start, concentrate and judge with numpy, one group after the other."""
    floors = np.array(list(quality.FLOORS.values()))

    def quantile(x, share):
        cells = np.sort(np.floor(x * quality.GRID))
        return (cells[int(np.ceil(share * len(cells))) - 1] + 1) / quality.GRID

    groups = {}
    for key, lang, source, counts in rows:
        if not counts[5]:
            n = max(counts[0], 1)
            x = [np.log(n), np.log(counts[1] / n), np.log1p(100 * counts[2] / n), np.log1p(100 * counts[4] / n), np.log1p(counts[3])]
            groups.setdefault((lang, source), []).append((key, x))
    judged = {}
    for (lang, source), members in groups.items():
        judged.setdefault((lang, source) if len(members) >= quality.LEAST_GROUP else (lang,), []).extend(members)
    out = {}
    for members in judged.values():
        if len(members) < quality.LEAST_GROUP:
            continue
        x = np.array(sorted({tuple(v) for _, v in members}))
        m = np.array([quantile(c, 0.5) for c in x.T])
        s = np.array([quantile(np.abs(c - a), 0.5) for c, a in zip(x.T, m)])
        d2 = (((x - m) / (1.4826 * s + floors)) ** 2).sum(1)
        for _ in range(quality.STEPS):
            near = x[d2 < quantile(d2, quality.INSIDE)]
            centre, inverse = near.mean(0), np.linalg.inv(np.cov(near.T, bias=True) + np.diag(floors**2))
            d2 = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre)
        scale = max(1.0, quantile(d2, 0.5) / quality.MEDIAN_CHI2)
        for key, v in members:
            out[key] = (np.array(v) - centre) @ inverse @ (np.array(v) - centre) / scale
    return out


def test_query_against_brute_force(spark):
    docs = table(spark, DATA, "documents").collect()
    want = {d.doc_id: plain_counts(d.text) for d in docs}
    d2 = plain_verdicts([(d.doc_id, d.lang, d.source, want[d.doc_id]) for d in docs])
    found = QUERIES["op2_quality"](spark, DATA).collect()
    assert len(found) == len(docs)
    for r in found:
        assert tuple(r[c] for c in COLUMNS[1:]) == want[r.doc_id]
        if r.base_failed:
            continue
        assert (r.d2 is None) == (r.doc_id not in d2)
        if r.d2 is not None:
            assert abs(r.d2 - d2[r.doc_id]) < 1e-6 * max(1, r.d2)
        assert r.kept == ((r.d2 or 0) <= quality.CUTOFF)
    assert not any(r.kept for r in found if r.base_failed)


def test_labelled_documents(spark):
    """No document of good quality is rejected by its distance, and some bad ones are."""
    kept = {r.doc_id: r.kept for r in QUERIES["op2_quality"](spark, DATA).collect() if not r.base_failed}
    labels = duckdb.sql(f"select doc_id, quality from '{DATA}/labels.parquet'").fetchall()
    assert all(kept.get(i, True) for i, good in labels if good)
    assert sum(not kept.get(i, True) for i, good in labels if not good) >= 10


def test_no_python_in_the_plan(spark):
    plan = quality.with_counts(table(spark, DATA, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "a b c a b c a b", "a\n\na\n \n \na \nb" * 3, "x " * 70000, "é#|<é " * 60, "a\x0bb\x0cc d e"]
    rows = [(i, t, "en" if i % 2 else None, None, 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "a b", None, "s", 1)]
    rows += [(100 + i, " ".join(f"w{(i * 31 + j * j) % 997}" for j in range(60)), "en", "s", 1) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")
    found = quality.quality(docs).collect()
    assert len(found) == len(rows)
    want = sorted((r[0] if r[0] is not None else -1, *plain_counts(r[1])) for r in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in COLUMNS[1:])) for r in found)
    assert got == want
    assert quality.quality(docs.limit(0)).count() == 0
