"""Language of texts by a linear-chain conditional random field over their words.

Words are runs of letters. A word's score for each language is the sum of the weights of its character n-grams (with the word's ends, so
affixes are among them) and of its entry in a lexicon counted over all labelled documents; learned transitions tie
neighbouring words. Forward-backward gives each word's probabilities, and so labels code-switched text too.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import release_worker, slices

SLICE_BYTES = 1 << 19
GRAM_ROWS = 1 << 16
LEXICON_ROWS = 1 << 15
GRAMS = (2, 3, 4)
SEGMENT = 256
# Training takes at most so many documents, evenly from the languages, and so many steps on code-switched sequences made of them.
SAMPLE_DOCS = 1200
STEPS, SEQUENCES, SEQUENCE_WORDS = 240, 32, 64
SMOOTHING = 5.0
UNDETERMINED = "und"
FIRST, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x9FB21C651E98DF25)


@functools.cache
def letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else 0. (Lower cases of several letters stay as they are.)"""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


class Words:
    """The words of some texts: n-gram rows of each place, the first place of each word, and the text it is from."""

    def __init__(self, texts: list[str]):
        joined = "\0".join(["", *texts, ""])
        code = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        place = np.arange(len(code))
        kept = (code > 0) | np.concatenate([[True], code[:-1] > 0])  # letters, and one gap behind each word
        kept[0] = True
        self.code, place = code[kept], place[kept]
        gap = np.flatnonzero(self.code == 0)
        self.first, last = gap[:-1], gap[1:]  # a word lies between two gaps
        self.word = np.zeros(len(self.code), np.int64)
        self.word[self.first[1:]] = 1
        self.word = np.cumsum(self.word)
        self.last = last[np.minimum(self.word, max(len(last) - 1, 0))] if len(last) else np.zeros(len(self.code), np.int64)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(bounds, place[self.first + 1] - 1, side="right") if len(last) else np.zeros(0, np.int64)
        self.count = len(last)

    def grams(self) -> Iterator[np.ndarray]:
        """For each n the weight row of the n-gram that starts at each place; the last row where there is none."""
        value, place, size = self.code * FIRST, np.arange(len(self.code)), len(self.code)
        for n in range(2, GRAMS[-1] + 1):
            value = value * STEP
            value[: size - n + 1] += self.code[n - 1 :] * FIRST
            row = ((value ^ (value >> np.uint64(31))) >> np.uint64(8)).astype(np.int64) & (GRAM_ROWS - 1)
            row[place + n - 1 > self.last] = GRAM_ROWS
            if n in GRAMS:
                yield row

    def lexicon_rows(self) -> np.ndarray:
        if not self.count:
            return np.zeros(0, np.int64)
        inside = np.arange(len(self.code)) - self.first[np.minimum(self.word, self.count - 1)]
        mixed = (self.code + inside.astype(np.uint64) * np.uint64(0x1F123BB5)) * np.uint64(0x9FB21C651E98DF25)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * (self.code > 0)
        whole = np.add.reduceat(mixed, self.first)
        return ((whole ^ (whole >> np.uint64(33))) & np.uint64(LEXICON_ROWS - 1)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # GRAM_ROWS + 1 by languages; the last row stays 0
    lexicon: np.ndarray  # log odds
    trust: float  # weight of the lexicon
    moves: np.ndarray  # from, to
    start: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        if not words.count:
            return np.zeros((0, len(self.languages)))
        places = np.zeros((len(words.code), len(self.languages)), np.float32)
        for row in words.grams():
            places += self.grams[row]
        return np.add.reduceat(places, words.first, axis=0)[: words.count].astype(float) + self.trust * self.lexicon[words.lexicon_rows()]

    def probabilities(self, words: Words) -> np.ndarray:
        """Of each language for each word, given its text."""
        return forward_backward(self.scores(words), self.moves, self.start, np.diff(words.text, prepend=-1) > 0)


def forward_backward(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Marginals of one chain that is cut where ``begins``: it is folded to segments, whose products are chained first."""
    return _both_ways(scores, moves, start, begins)[0]


def _both_ways(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals, weight of each word and all behind it by language; the scale of a row of these is open)."""
    count, kinds = scores.shape
    if count == 0:
        return np.zeros((0, kinds)), np.zeros((0, kinds))
    segments = -(-count // SEGMENT)
    length = -(-count // segments)
    step, first = np.exp(moves - moves.max()), np.exp(start - start.max())
    local = np.ones((length * segments, kinds))
    local[:count] = np.exp(scores - scores.max(axis=1, keepdims=True))
    local = np.ascontiguousarray(local.reshape(segments, length, kinds).swapaxes(0, 1))
    cut = np.zeros(length * segments, bool)
    cut[:count] = begins
    cut[count : count + 1] = True  # nothing flows back from the filling
    cut = [np.flatnonzero(c) for c in cut.reshape(segments, length).T]

    def even(x, t):  # often enough to stay far from the smallest numbers
        return x / x.max(axis=tuple(range(1, x.ndim)), keepdims=True) if t % 8 == 0 else x

    whole = np.tile(np.eye(kinds), (segments, 1, 1))
    for t in range(length):
        total = whole[cut[t]].sum(axis=2, keepdims=True)
        whole = whole.reshape(-1, kinds) @ step
        whole = whole.reshape(segments, kinds, kinds)
        whole[cut[t]] = total * first
        whole = even(whole * local[t][:, None, :], t)
    heads, tails = np.ones((segments, kinds)), np.ones((segments, kinds))
    for s in range(1, segments):
        now = heads[s - 1] @ whole[s - 1]
        heads[s] = now / now.max()
    for s in range(segments - 2, -1, -1):
        now = whole[s + 1] @ tails[s + 1]
        tails[s] = now / now.max()
    found = np.empty((length, segments, kinds))
    now = heads
    for t in range(length):
        now = now @ step
        now[cut[t]] = first
        now = even(now * local[t], t)
        found[t] = now
    now, ahead = tails, np.empty((length, segments, kinds))
    for t in range(length - 1, -1, -1):
        found[t] *= now
        ahead[t] = now * local[t]
        now = ahead[t] @ step.T
        now[cut[t]] = 1.0
        now = even(now, t)
    found, ahead = (x.swapaxes(0, 1).reshape(-1, kinds)[:count] for x in (found, ahead))
    return found / found.sum(axis=1, keepdims=True), ahead


def expected_moves(found: np.ndarray, ahead: np.ndarray, moves: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How often each move is expected between neighbouring words of a text: a word's marginal, times the chance of the next one's
    language given its own."""
    inner = ~begins[1:]
    step = np.exp(moves - moves.max())
    behind = ahead[1:][inner]
    behind = behind / behind.max(axis=1, keepdims=True)
    return step * ((found[:-1][inner] / (behind @ step.T)).T @ behind)


def train(texts: list[str], langs: list[str], languages: list[str], counts: np.ndarray) -> Model:
    """Maximum likelihood by AdaGrad on sequences whose words come in runs from documents of changing languages."""
    kinds, rng = len(languages), np.random.default_rng(11)
    share = (counts + SMOOTHING * counts.sum(0) / max(counts.sum(), 1)) / (counts.sum(1, keepdims=True) + SMOOTHING)
    lexicon = np.log(np.maximum(share, 1e-6))
    lexicon -= lexicon.mean(1, keepdims=True)
    model = Model(languages, np.zeros((GRAM_ROWS + 1, kinds), np.float32), lexicon, 0.5, np.zeros((kinds, kinds)), np.zeros(kinds))
    parsed = [Words([t]) for t in texts]
    plain = [_spelled(w) for w in parsed]
    by_kind = [[p for p, lang in zip(plain, langs) if lang == want and p] for want in languages]
    usable = [k for k in range(kinds) if by_kind[k]]
    if kinds < 2 or not usable:
        return model
    squares = [np.full_like(model.grams, 1e-6), 1e-6, np.full((kinds, kinds), 1e-6), np.full(kinds, 1e-6)]
    for _ in range(STEPS):
        lines, truth = [], []
        for _ in range(SEQUENCES):
            line: list[str] = []
            while len(line) < SEQUENCE_WORDS:
                k = usable[rng.integers(len(usable))]
                source = by_kind[k][rng.integers(len(by_kind[k]))]
                run, at = int(rng.integers(8, 40)), int(rng.integers(len(source)))
                line += source[at : at + run]
                truth += [k] * len(source[at : at + run])
            lines.append(" ".join(line))
        words, truth = Words(lines), np.array(truth)
        begins = np.diff(words.text, prepend=-1) > 0
        scores = model.scores(words)
        found, ahead = _both_ways(scores, model.moves, model.start, begins)
        apart = found.copy()
        apart[np.arange(len(truth)), truth] -= 1
        slope = np.zeros_like(model.grams)
        own = np.minimum(words.word, words.count - 1)
        for row in words.grams():
            for k in range(kinds):
                slope[:, k] += np.bincount(row, weights=apart[own, k], minlength=GRAM_ROWS + 1)[: GRAM_ROWS + 1]
        slope[-1] = 0
        inner = ~begins[1:]
        seen = np.zeros((kinds, kinds))
        np.add.at(seen, (truth[:-1][inner], truth[1:][inner]), 1)
        slopes = [
            slope, float((apart * lexicon[words.lexicon_rows()]).sum()), expected_moves(found, ahead, model.moves, begins) - seen, apart[begins].sum(0),
        ]
        steps = []
        for i, s in enumerate(slopes):
            squares[i] = squares[i] + s * s
            steps.append(0.2 * s / np.sqrt(squares[i]))
        model.grams -= steps[0].astype(np.float32)
        model.trust = max(0.05, model.trust - steps[1])
        model.moves -= steps[2]
        model.start -= steps[3]
    return model


def _spelled(words: Words) -> list[str]:
    line = words.code.astype(np.uint32)
    line[line == 0] = ord(" ")
    return line.tobytes().decode("utf-32-le", "surrogatepass").split(" ")[1:-1] if words.count else []


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def lexicon_counts(labelled: DataFrame, languages: list[str], text: str, lang: str) -> np.ndarray:
    """Words of all labelled texts by lexicon row and language. The driver gets at most LEXICON_ROWS sums per language."""
    index = {name: k for k, name in enumerate(languages)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        table = np.zeros((len(languages), LEXICON_ROWS), np.int64)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                words = Words([t or "" for t in part.column(text).to_pylist()])
                kind = np.array([index[x] for x in part.column(lang).to_pylist()], np.int64)
                cells = kind[words.text] * LEXICON_ROWS + words.lexicon_rows()
                table += np.bincount(cells, minlength=table.size).reshape(table.shape)
        kind, row = np.nonzero(table)
        if len(row):
            yield pa.RecordBatch.from_arrays(
                [pa.array(row.astype(np.int32)), pa.array(kind.astype(np.int32)), pa.array(table[kind, row])], names=["row", "kind", "n"]
            )

    out = np.zeros((LEXICON_ROWS, len(languages)))
    sums = labelled.mapInArrow(work, "row int, kind int, n long").groupBy("row", "kind").agg(F.sum("n").alias("n"))
    for r in sums.toArrow().to_batches():
        out[r.column("row").to_numpy(), r.column("kind").to_numpy()] = r.column("n").to_numpy()
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages of ``labelled``: lexicon from all its rows, weights from ``SAMPLE_DOCS`` of them."""
    labelled = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(text, lang)
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).agg(F.count("*")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((GRAM_ROWS + 1, 0), np.float32), np.zeros((LEXICON_ROWS, 0)), 0.0, np.zeros((0, 0)), np.zeros(0))
    counts = lexicon_counts(labelled, languages, text, lang)
    # The least of hash times size: as many of each language, whatever their shares.
    weight = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, float(sizes[k]))]), F.col(lang))
    drawn = F.pmod(F.xxhash64(text), F.lit(1 << 40)).cast("double") * weight
    ranked = labelled.select(text, lang, drawn.alias("drawn"))
    # Copies have one hash and are one draw.
    bound = ranked.select("drawn").distinct().orderBy("drawn").limit(SAMPLE_DOCS).agg(F.max("drawn")).first()[0]
    drawn_once = ranked.filter(F.col("drawn") <= bound).dropDuplicates(["drawn", lang])
    sample = drawn_once.orderBy("drawn", lang).limit(SAMPLE_DOCS).collect()
    return train([r[0] or "" for r in sample], [r[1] for r in sample], languages, counts)


def predict(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """All columns (the text only with ``keep_text``), with lang_pred and score.

    The language with the highest mean probability over the words, and that mean; of equal ones the first by name. A text
    without a letter (null too), or a model without languages, gives ``und`` with score 0.
    """
    kept = [c for c in docs.columns if keep_text or c != text]
    empty = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))
    # Of fixed size: weight rows by languages. As plain arrays, which a worker can load without this package.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        model = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                found, score = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                words = Words([t or "" for t in part.column(text).to_pylist()])
                if words.count and model.languages:
                    chances = model.probabilities(words)
                    begins = np.flatnonzero(np.diff(words.text, prepend=-1) > 0)
                    rows = words.text[begins]
                    mean = np.add.reduceat(chances, begins, axis=0) / np.diff(begins, append=words.count)[:, None]
                    best = mean.argmax(axis=1)
                    score[rows] = np.clip(mean[np.arange(len(rows)), best], 0, 1)
                    for row, k in zip(rows.tolist(), best.tolist()):
                        found[row] = model.languages[k]
                columns = [*(part.column(c) for c in kept), pa.array(found, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    return docs.mapInArrow(work, empty.schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, held_out, lang_pred and score of each row.

    The model learns from text and non-null language of the rows that are not held out (crc32 of the key as text, mod 5; a null
    key counts as held out); a prediction sees the text only.
    """
    out = F.coalesce(held_out(key), F.lit(True))
    model = fit(docs.filter(~out).select(text, lang), text, lang)
    return predict(docs.select(key, out.alias("held_out"), text), model, text)


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a score of ``least`` or more, by a model of all labelled rows."""
    model = fit(docs, text, lang)
    columns = docs.columns
    clear = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])  # so that no name clashes
    found = predict(clear, model, f"c{columns.index(text)}", keep_text=True).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def label_words(text: str, model: Model) -> list[tuple[str, str]]:
    """(word, language) of a text that may switch languages."""
    words = Words([text])
    if not words.count or not model.languages:
        return []
    best = model.probabilities(words).argmax(axis=1)
    return [(w, model.languages[k]) for w, k in zip(_spelled(words), best)]
