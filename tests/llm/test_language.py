import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from skytally.llm import language
from skytally.llm.common import table
from skytally.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plain_marginals(scores, moves, start):
    """One chain, word by word."""
    n, kinds = scores.shape
    a, b = np.zeros((n, kinds)), np.ones((n, kinds))
    for t in range(n):
        a[t] = (np.exp(start) if t == 0 else a[t - 1] @ np.exp(moves)) * np.exp(scores[t])
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = np.exp(moves) @ (np.exp(scores[t + 1]) * b[t + 1])
        b[t] /= b[t].sum()
    return a * b / (a * b).sum(1, keepdims=True)


@pytest.mark.parametrize("kinds", [1, 2, 4])
def test_folded_chain(kinds, monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 7)
    rng = np.random.default_rng(kinds)
    sizes = [1, 2, 30, 1, 55, 3]
    scores = rng.normal(0, 3, (sum(sizes), kinds))
    moves, start = rng.normal(0, 1, (kinds, kinds)), rng.normal(0, 1, kinds)
    texts = np.repeat(np.arange(len(sizes)), sizes)
    found = language.forward_backward(scores, moves, start, np.diff(texts, prepend=-1) > 0)
    want = np.concatenate([plain_marginals(scores[texts == i], moves, start) for i in range(len(sizes))])
    assert np.allclose(found, want, atol=1e-9)


def likelihood(scores, moves, start, texts, truth):
    """Logarithm of the probability of the true labels, text by text."""
    total = 0.0
    for i in np.unique(texts):
        s, y = scores[texts == i], truth[texts == i]
        total += start[y[0]] + s[np.arange(len(y)), y].sum() + moves[y[:-1], y[1:]].sum()
        a = start + s[0]
        for row in s[1:]:
            a = np.logaddexp.reduce(a[:, None] + moves, axis=0) + row
        total -= np.logaddexp.reduce(a)
    return total


@pytest.mark.parametrize("segment", [4, 64])
def test_expected_moves_are_the_slope_of_the_likelihood(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    rng = np.random.default_rng(5)
    texts = np.repeat([0, 1, 2], [1, 25, 14])
    scores, moves, start = rng.normal(0, 2, (40, 3)), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
    truth, begins = rng.integers(0, 3, 40), np.diff(texts, prepend=-1) > 0
    expected = language.expected_moves(*language._both_ways(scores, moves, start, begins), moves, begins)
    seen = np.zeros((3, 3))
    np.add.at(seen, (truth[:-1][~begins[1:]], truth[1:][~begins[1:]]), 1)
    for i in range(3):
        for j in range(3):
            up, down = moves.copy(), moves.copy()
            up[i, j] += 1e-5
            down[i, j] -= 1e-5
            slope = (likelihood(scores, up, start, texts, truth) - likelihood(scores, down, start, texts, truth)) / 2e-5
            assert abs((seen - expected)[i, j] - slope) < 1e-5


def test_null_texts_and_copies_do_not_crowd_out_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 60)
    rows = [(None, "en")] * 300 + [("the same text for ever and ever", "en")] * 300
    rows += [(f"der die und das nicht auch {i} wird werden", "de") for i in range(60)]
    rows += [(f"the of and that with this {i} have will", "en") for i in range(60)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["de", "en"] and np.abs(model.grams).max() > 0 and np.abs(model.moves).max() > 0
    assert [lang for _, lang in language.label_words("der die und the of and", model)] == ["de"] * 3 + ["en"] * 3


def test_workers_need_no_package_for_the_model():
    import pickle

    model = language.Model(["a"], np.zeros((2, 1)), np.zeros((1, 1)), 0.5, np.zeros((1, 1)), np.zeros(1))
    plain = pickle.dumps(tuple(getattr(model, f.name) for f in language.fields(model)))
    assert b"skytally" not in plain


def test_words():
    texts = ["", "Hello wörld 12", "...", "a", "É-b\0c", "x" * 300]
    words = language.Words(texts)
    assert language._spelled(words) == ["hello", "wörld", "a", "é", "b", "c", "x" * 300]
    assert words.text.tolist() == [1, 1, 3, 4, 4, 4, 5]
    rows = list(words.grams())
    alone = list(language.Words(["wörld"]).grams())
    at = words.first[1]
    for many, one in zip(rows, alone):
        assert many[at : at + 6].tolist() == one[:6].tolist()
    assert words.lexicon_rows()[1] == language.Words(["WÖRLD"]).lexicon_rows()[0]
    assert language.Words(["", "12"]).count == 0


def test_held_out_accuracy(spark):
    docs = table(spark, DATA, "documents").select("doc_id", "lang", "text")
    found = {r.doc_id: r for r in QUERIES["op3_language"](spark, DATA).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    held = [d for d in rows if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r.held_out} == {d.doc_id for d in held}
    lettered = [d for d in held if any(c.isalpha() for c in d.text)]
    right = sum(found[d.doc_id].lang_pred == d.lang for d in lettered)
    assert right >= 0.98 * len(lettered)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_code_switching(spark):
    docs = table(spark, DATA, "documents").filter(~language.held_out())
    model = language.fit(docs)
    out = table(spark, DATA, "documents").filter(language.held_out()).filter(F.length("text") > 800).collect()
    right = total = 0
    for a, b in zip([d for d in out if d.lang == "en"], [d for d in out if d.lang == "de"]):
        for d in (a, b):
            truth = d.lang
            part = " ".join(a.text.split()[10:25]) + " " + " ".join(b.text.split()[10:25])
            labels = [lang for _, lang in language.label_words(part, model)]
            half = len(language.label_words(" ".join(a.text.split()[10:25]), model))
            own = labels[:half] if truth == "en" else labels[half:]
            right += sum(x == truth for x in own)
            total += len(own)
    assert total > 300 and right >= 0.9 * total


def test_odd_rows(spark):
    rows = [(i, f"der die und das {i}" if i % 2 else f"the of and a {i}", "de" if i % 2 else "en", "s") for i in range(60)]
    rows += [(61, None, "en", "s"), (62, "12 ...", "de", "s"), (None, "the of", "en", "s"), (64, "the the", None, None), (61, None, "en", "s")]
    rows += [(65, "und " * 60000, "de", "s"), (66, "", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert [(by[i].lang_pred, by[i].score) for i in (61, 62, 66)] == [("und", 0.0)] * 3
    assert by[64].lang_pred == "en" and by[65].lang_pred == "de" and by[None].held_out
    none = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.identify(none).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0
