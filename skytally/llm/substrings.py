"""Exact removal of byte strings that start twice or more anywhere in the texts.

Texts are parsed into phrases that end at triggers of a rolling hash. Equal strings have their triggers at equal places, so strings
that follow one trigger are told apart together: the parse is compared first, single bytes only where it leaves the answer open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm import phrases
from skytally.llm.common import pack, parts_for, row_key, runs, slices, text_bytes, unpack

SLICE_BYTES = 1 << 20  # of text hashed at once
DEAL_KEYS = 1 << 19  # keys that are folded before they are sent
PART_BYTES = 24 << 20  # of text for each partition of keys
MORE = 128  # a spot is a run of starts: (first * MORE + bytes to the trigger) * MORE + further starts
SPOT = MORE * MORE


class Window:
    """Sizes that follow from the length of the strings."""

    def __init__(self, length: int):
        self.length = length
        self.reach = length // 2 + 1  # a trigger is among so many first bytes of a string
        self.core = length - self.reach + 1  # so many bytes from the trigger on belong to the string
        if self.core < phrases.GRAM or self.reach >= MORE or length < 128:
            raise ValueError("strings of 128 to 253 bytes")


def _segments(batch: pa.RecordBatch, over: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, offset in its text, bytes, text bounds): many short texts, or part of a long one with ``over`` bytes of the next part."""
    row = 0
    for part in slices(batch, "text", SLICE_BYTES):
        data, bounds = text_bytes(part.column("text"))
        if len(data) <= 2 * SLICE_BYTES:
            yield row, 0, data, bounds
        else:  # one text
            for at in range(0, len(data), SLICE_BYTES):
                cut = data[at : at + SLICE_BYTES + over]
                yield row, at, cut, np.array([0, len(cut)])
        row += part.num_rows


def _first_spots(window: Window, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, rows, spots): for each run of strings with one trigger, a hash of what they have in common behind it."""
    length = window.length
    over = length - 1
    for row, at, data, bounds in _segments(batch, over):
        if len(data) < length:
            continue
        known = phrases.levels(data, phrases.GRAM, phrases.block_of(window.core))
        trigger = phrases.triggers(known, window.reach)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        start = np.flatnonzero(np.arange(len(data)) + length <= bounds[owner + 1])
        if len(start) == 0:
            continue
        first, end = runs(trigger[start])
        lo, hi = start[first], start[end - 1]
        keys = phrases.hash_of(known, trigger[lo], window.core)
        yield keys, row + owner[lo], _spot(lo - bounds[owner[lo]] + at, trigger[lo] - lo, hi - lo)


def _spots(column: pa.Array) -> list[np.ndarray]:
    """The spots that the rows of a column hold, sorted; null is none."""
    return [np.unique(np.frombuffer(x.as_py() or b"", "<i8")) for x in column]


def _placed(window: Window, batch: pa.RecordBatch, spots: list[np.ndarray]):
    """(hashes, rows, offsets, spots, first places) of the spots of each segment of a batch."""
    for row, at, data, bounds in _segments(batch, window.length + MORE):
        long = len(bounds) == 2 and (at > 0 or len(data) > 2 * SLICE_BYTES or at + len(data) < _size(batch, row))
        own, rows = [], []
        for k in range(len(bounds) - 1):
            mine = spots[row + k]
            if long:
                mine = mine[(mine // SPOT >= at) & (mine // SPOT < at + SLICE_BYTES)]
            own.append(mine)
            rows.append(np.full(len(mine), k))
        mine, rows = np.concatenate(own), np.concatenate(rows)
        if len(mine):
            known = phrases.levels(data, phrases.block_of(window.core), 128)
            yield known, row + rows, at - bounds[rows], mine, mine // SPOT - at + bounds[rows]


def _size(batch: pa.RecordBatch, row: int) -> int:
    return len(text_bytes(batch.column("text").slice(row, 1))[0])


def _stretch_keys(window: Window, batch: pa.RecordBatch):
    """(keys, rows, spots, cores): hashes of the whole stretch of each first spot and of what follows its trigger."""
    for known, rows, _, spots, lo in _placed(window, batch, _spots(batch.column("first"))):
        stretch = phrases.span_hash(known, lo, lo + spots % MORE + window.length, window.length)
        yield stretch, rows, spots, phrases.hash_of(known, lo + spots // MORE % MORE, window.core)


def _string_keys(window: Window, batch: pa.RecordBatch):
    """(keys, rows, spots): hashes of the single strings that the rounds before leave open."""
    lists = zip(*(_spots(batch.column(c)) for c in ("first", "whole", "mixed")))
    left = [np.union1d(np.setdiff1d(first, whole), mixed) for first, whole, mixed in lists]
    for known, rows, shift, spots, lo in _placed(window, batch, left):
        many = spots % MORE + 1
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        lo = np.repeat(lo, many) + step
        yield phrases.hash_of(known, lo, window.length), np.repeat(rows, many), _spot(lo + np.repeat(shift, many), 0, 0)


def _spot(first, to_trigger, more):
    return (first * MORE + to_trigger) * MORE + more


# What tasks send each other: many keys in one row, with the places that ask about them.
RECORDS = "part int, kind int, keys binary, stretches binary, rids binary, spots binary"
NAMES = ["part", "kind", "keys", "stretches", "rids", "spots"]
KINDS = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
REPEATS, MIXED = 0, 1  # Is the key there twice? Do several stretches share the core?


class _Block:
    """What one block of text sends: keys with the place that asks, keys without, and answers known already."""

    def __init__(self, parts: int):
        self.parts, self.rows = parts, []

    def _part(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) >> np.uint64(17)) % np.uint64(self.parts)).astype(np.int64)

    def ask(self, kind: int, keys, stretches, rids, spots) -> None:
        part = self._part(keys)
        order = np.lexsort((spots, rids, part))
        part = part[order]
        for a, b in zip(*runs(part)):
            some = order[a:b]
            plain = [b"" if c is None else c[some].tobytes() for c in (keys, stretches)]
            self.rows.append((int(part[a]), kind, *plain, pack(rids[some]), pack(spots[some])))

    def tell(self, kind: int, keys) -> None:
        keys = keys[np.argsort(self._part(keys), kind="stable")]
        part = self._part(keys)
        for a, b in zip(*runs(part)):
            self.rows.append((int(part[a]), kind, keys[a:b].tobytes(), b"", b"", b""))

    def answer(self, kind: int, rids, spots) -> None:
        part = self._part(rids)
        order = np.lexsort((spots, rids, part))
        part = part[order]
        for a, b in zip(*runs(part)):
            some = order[a:b]
            self.rows.append((int(part[a]), kind, b"", b"", pack(rids[some]), pack(spots[some])))

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else ((),) * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], names=NAMES)


def _sent(parts: int, rids, keys, spots, cores=None) -> pa.RecordBatch:
    """A key that the block holds twice goes without a place: the answer for its places is known. So one string in
    all texts reaches its task once per block. The same holds for cores that the block has in several stretches."""
    block = _Block(parts)
    order = np.argsort(keys, kind="stable")
    keys, rids, spots = keys[order], rids[order], spots[order]
    start, end = runs(keys)
    twice = np.repeat(end - start > 1, end - start)
    block.ask(REPEATS, keys[~twice], None, rids[~twice], spots[~twice])
    block.tell(REPEATS, keys[start[end - start > 1]])
    block.answer(REPEATS, rids[twice], spots[twice])
    if cores is not None:  # the first place of each stretch stands for it
        cores, keys, rids, spots = cores[order][start], keys[start], rids[start], spots[start]
        order = np.argsort(cores, kind="stable")
        cores, keys, rids, spots = cores[order], keys[order], rids[order], spots[order]
        start, end = runs(cores)
        several = np.repeat(end - start > 1, end - start)
        block.ask(MIXED, cores[~several], keys[~several], rids[~several], spots[~several])
        block.tell(MIXED, cores[start[end - start > 1]])
        block.answer(MIXED, rids[several], spots[several])
    return block.batch()


def _answers(parts: int):
    """Of the places whose question is answered by yes rids and spots, in one row for each part that rids are dealt to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {REPEATS: [], MIXED: []}
        sure: dict[int, list[tuple]] = {REPEATS: [], MIXED: []}
        for batch in batches:
            for kind, *data in ([x.as_py() for x in row] for row in zip(*(batch.column(c) for c in NAMES[1:]))):
                keys, stretches = (np.frombuffer(x, "<u8") for x in data[:2])
                rids, spots = (unpack(x) if x else np.zeros(0, np.int64) for x in data[2:])
                if len(keys) == 0:
                    sure[kind].append((rids, spots))
                elif len(rids) == 0:  # as if two places asked, of two stretches
                    two = np.repeat(np.array([0, 1], np.uint64), len(keys))
                    held[kind].append((np.tile(keys, 2), two, np.zeros(len(two), np.int64), np.full(len(two), -1)))
                else:
                    held[kind].append((keys, stretches if kind == MIXED else keys, rids, spots))
        block = _Block(parts)
        for kind in (REPEATS, MIXED):
            if held[kind]:
                keys, stretches, rids, spots = map(np.concatenate, zip(*held[kind]))
                order = np.lexsort((stretches, keys)) if kind == MIXED else np.argsort(keys)
                start, end = runs(keys[order])
                yes = end - start > 1
                if kind == MIXED:
                    yes = stretches[order[start]] != stretches[order[end - 1]]
                found = order[np.repeat(yes, end - start)]
                found = found[spots[found] >= 0]
                sure[kind].append((rids[found], spots[found]))
            if sure[kind]:
                block.answer(kind, *map(np.concatenate, zip(*sure[kind])))
        yield block.batch()

    return work


def _merged(names: list[str]):
    """One row per rid with the spots of each kind."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in names]
        for batch in batches:
            for kind, rids, spots in zip(*(batch.column(c) for c in ("kind", "rids", "spots"))):
                held[kind.as_py()].append((unpack(rids.as_py()), unpack(spots.as_py())))
        none = np.zeros(0, np.int64)
        sorted_ = []
        for parts in held:
            rids, spots = map(np.concatenate, zip(*parts)) if parts else (none, none)
            order = np.lexsort((spots, rids))
            sorted_.append((rids[order], spots[order]))
        every = np.unique(np.concatenate([r for r, _ in sorted_]))
        bounds = [(np.searchsorted(r, every), np.searchsorted(r, every, side="right")) for r, _ in sorted_]
        for at in range(0, len(every), 20_000):
            some = slice(at, at + 20_000)
            lists = [
                pa.array([spots[a:b].tobytes() for a, b in zip(low[some].tolist(), high[some].tolist())], pa.binary())
                for (_, spots), (low, high) in zip(sorted_, bounds)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(every[some]), *lists], names=["rid", *names])

    return work


def _round(rows: DataFrame, found, parts: int, names: list[str]) -> DataFrame:
    """rid and, by kind, the spots whose question is answered by yes. ``found`` gives (keys, rows, spots[, cores]) of a batch."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            for keys, rows, *rest in found(batch):
                held.append((rid[rows], keys, *rest))
                size += len(keys)
                if size >= DEAL_KEYS:
                    yield _sent(parts, *map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield _sent(parts, *map(np.concatenate, zip(*held)))

    asked = rows.mapInArrow(ask, RECORDS).repartition(parts, "part")
    answered = asked.mapInArrow(_answers(parts), RECORDS).repartition(parts, "part")
    return answered.mapInArrow(_merged(names), ", ".join(["rid long", *(f"{n} binary" for n in names)]))


def repeated_spans(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(texts dealt by rid, rid with the spots ``whole`` and ``single`` whose strings all repeat).

    ``texts`` has rid (equal rows share it) and text. Three rounds of keys:
    1. What follows the trigger of a run of strings, the core. Most cores are there once, and their strings too.
    2. The whole stretch of a run. If it is there twice, so is each of its strings.
    3. The single strings of the other runs, and of one place (per block of text) of each stretch that shares its core with another.
    """
    window = Window(length)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(size, PART_BYTES, texts.sparkSession.sparkContext.defaultParallelism)
    first = _round(texts, lambda batch: _first_spots(window, batch), parts, ["first"])
    dealt = texts.repartition(parts, "rid")
    second = _round(dealt.join(first, "rid"), lambda batch: _stretch_keys(window, batch), parts, ["whole", "mixed"])
    open_ = dealt.join(first, "rid").join(second, "rid", "left")
    third = _round(open_, lambda batch: _string_keys(window, batch), parts, ["single"])
    return dealt, second.select("rid", "whole").join(third, "rid", "full")


def remove_repeats(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of each row, with ``texts`` also the remaining bytes.

    Every byte is removed that a string of ``length`` bytes covers which starts anywhere else too, in the same text, another one
    or a repeated row. Strings are judged on the input and never cross texts. Null is the empty text, shorter texts
    stay as they are, a null key is a key, and other columns are not read. Strings are compared by 64-bit hashes.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", row_key("key", "text"))
    dealt, spans = repeated_spans(rows.select("rid", "text", "key"), length)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            out = []
            for k, lists in enumerate(zip(_spots(batch.column("whole")), _spots(batch.column("single")))):
                body, spots = data[bounds[k] : bounds[k + 1]], np.concatenate(lists)
                starts = spots // SPOT
                ends = starts + spots % MORE + length
                change = np.zeros(len(body) + 1, np.int32)
                np.add.at(change, starts, 1)
                np.add.at(change, ends, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = body[~gone].tobytes()
                begun = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(body), int(gone.sum()), begun, hashlib.sha256(kept).hexdigest(), kept)[: 5 if texts else 4])
            columns = [pa.array(list(c)) for c in zip(*out)]
            names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names=names[: 1 + len(columns)])

    return dealt.join(spans, "rid", "left").mapInArrow(work, schema)
