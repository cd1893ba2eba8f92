"""Fuzzy passages that repeat across texts: shared seeds, collinear chains of them, and their alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm import phrases
from skytally.llm.common import pack, parts_for, release_worker, runs, slices, stored, stored_buckets, text_bytes, unpack

K = 5  # words of a seed
REACH = 8  # of so many seeds in a row the one with the least hash is taken
LEAST_WORDS = 50
SIMILARITY = 0.8
GAP_COST = 0.1  # per word that a chain skips on either side; a seed counts K
FLANK = 64  # windows of words are cut at multiples of this, so that many chains ask for the same one
SLICE_BYTES = 1 << 20
DEAL_SEEDS = 1 << 18  # seeds that are folded before they are sent
PART_BYTES = 8 << 20  # of text for each partition of seeds
KEY_PARTS = 2  # partitions of the second look's keys for each of those
LOOSE = int(K / GAP_COST / 2)  # so many words between seeds on both sides cost what a seed counts
SHORT = LEAST_WORDS - 2 * (K + REACH)  # shorter stretches of seeds are not part of a passage
PAIRED = 59  # most words from one seed of a pair to the other
WINDOW = 127  # in place of that distance: all LEAST_WORDS words

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEAR = 64  # places in a word whose bytes' hashes come from a table


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first byte, byte behind) of each word of some texts; A-Z count as a-z."""
    found, at = [], 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data) and not SPACE[data[end]] and end not in bounds[np.searchsorted(bounds, end) :][:1]:
            more = np.flatnonzero(SPACE[data[end : end + SLICE_BYTES]])
            stop = end + (int(more[0]) if len(more) else SLICE_BYTES)
            end = min(stop, int(bounds[np.searchsorted(bounds, end)]), len(data))
        found.append(_words(data[at:end], np.unique(np.clip(bounds, at, end)) - at, at))
        at = end
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    hashes, first, behind = map(np.concatenate, zip(*found))
    return hashes, np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(first, bounds))), first, behind


def _byte_hashes(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hash of each byte at a place of its word; nothing for white space."""
    value = (LOWER[byte].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8))) * phrases.FACTORS[0]
    value = (value ^ (value >> np.uint64(29))) * phrases.FACTORS[1] * ~SPACE[byte]
    return value ^ (value >> np.uint64(32))


BYTE_HASHES = _byte_hashes(np.tile(np.arange(256), NEAR), np.repeat(np.arange(NEAR), 256))


def _words(data: np.ndarray, cuts: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~SPACE[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[cuts] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= fresh[1:-1] | ~word[:-1]
    ends[:-1] &= fresh[1:-1] | ~word[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    if len(first) == 0:
        return np.zeros(0, np.uint64), first, last
    byte = data[first[0] :]
    place = np.arange(first[0], len(data)) - np.repeat(first, np.diff(first, append=len(data)))
    mixed = BYTE_HASHES.take((place << 8) + byte, mode="clip")
    far = np.flatnonzero(place >= NEAR)
    if len(far):
        mixed[far] = _byte_hashes(byte[far], place[far])
    whole = np.add.reduceat(mixed, first - first[0])
    return whole * phrases.FACTORS[2], first + at, last + 1 + at


def seeds(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, place among the words) of the seeds taken. Texts of fewer than K + REACH - 1 words have none."""
    span = K + REACH - 1
    if len(hashes) < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = phrases.mixed(*(hashes[k : len(hashes) - K + 1 + k] for k in range(K)))
    place = np.arange(len(keys), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    taken = []
    for a in range(0, len(keys), 1 << 23):  # places must fit their bits
        part = phrases.mixed(keys[a : a + (1 << 23) + REACH]) & ~low | (low - (place[: (1 << 23) + REACH][: len(keys) - a]))
        if len(part) < REACH:
            break
        least = a + (low - (phrases.least_in_window(part, REACH) & low)).astype(np.int64)
        window = a + np.arange(len(least))
        taken.append(least[text[window] == text[window + span - 1]])
    places = np.concatenate(taken)  # these never fall
    places = places[np.concatenate([[True], places[1:] != places[:-1]])] if len(places) else places
    return keys[places], places


# ---- shared seeds ----------------------------------------------------------------------------------------------------

# Texts are numbered in the order of their ids, so one number tells which text it is and which of two comes first.
ASKED = "part int, keys binary, at binary, known binary"
NO_ID = np.iinfo(np.int64).max  # in place of null; such rows come last


def _order(keys) -> tuple[np.ndarray, np.ndarray]:
    """(order of 64-bit keys, the keys in it). Numbers of leading bits and row sort much faster than rows by their keys; the few rows that
    differ in the other bits only are sorted again by the whole key."""
    if keys.dtype != np.uint64:
        order = np.argsort(keys)
        return order, keys[order]
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    own = keys[order]
    falls = np.flatnonzero(own[1:] < own[:-1])
    if len(falls):
        lead = own & ~low
        first = np.unique(lead[falls])
        some = np.concatenate([np.arange(a, b) for a, b in zip(np.searchsorted(lead, first), np.searchsorted(lead, first, side="right"))])
        order[some] = order[some][np.argsort(own[some], kind="stable")]
        own[some] = keys[order[some]]
    return order, own


def _by_key(keys, *texts_places) -> np.ndarray:
    """Order by key, then text and place (the further columns). Most keys are there once, so few rows are sorted by more than that."""
    order, own = _order(keys)
    changed = own[1:] != own[:-1]
    tied = np.zeros(len(order), bool)
    tied[1:] |= ~changed
    tied[:-1] |= ~changed
    some = np.flatnonzero(tied)
    if len(some):
        rows, group = order[some], np.concatenate([[0], np.cumsum(changed)])[some]
        order[some] = rows[np.lexsort((*(c[rows] for c in reversed(texts_places)), group))]
    return order


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, number of each value among them). Numbers of value and row sort faster than rows by their values."""
    bits, least = len(values).bit_length(), int(values.min())
    if int(values.max()) - least >= 1 << (62 - bits):
        return np.unique(values, return_inverse=True)
    codes = np.sort((values - least) << bits | np.arange(len(values)))
    value = codes >> bits
    fresh = np.concatenate([[True], value[1:] != value[:-1]])
    number = np.empty(len(values), np.int64)
    number[codes & ((1 << bits) - 1)] = np.cumsum(fresh) - 1
    return value[fresh] + least, number


def _by_place(part, rids, places) -> np.ndarray:
    """Stable order by part, text and place. One number for all three sorts much faster than three columns."""
    if not len(rids):
        return np.zeros(0, np.int64)
    texts, number = _ranked(rids)
    width = int(places.max()) + 1
    rows = len(rids)
    if places.min() < 0 or (int(part.max()) + 1) * len(texts) * width * rows >= 1 << 62:
        return np.lexsort((places, rids, part))
    return np.sort(((part * len(texts) + number) * width + places) * rows + np.arange(rows)) % rows


def _ask(parts: int, nos, keys, places, again: bool) -> tuple[list[tuple], tuple]:
    """(rows that ask, matches known) of a block. The first text of the block that has a seed asks for it; other
    texts of the block take that one, further places in one text take its first place."""
    order = _by_key(keys, nos, places)
    nos, keys, places = nos[order], keys[order], places[order]
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    asks, later = np.flatnonzero(new_key), np.flatnonzero(~new_key)
    top = asks[np.cumsum(new_key)[later] - 1]  # first place in the block
    new_text = nos[later] != nos[later - 1]
    head = np.maximum.accumulate(np.where(new_text, later, top))  # first place of the seed in the text
    to = np.where(new_text, top, head)
    part = ((keys[asks] >> np.uint64(19)) % np.uint64(parts)).astype(np.int64)
    order = _by_place(part, nos[asks], places[asks])
    part, asks = part[order], asks[order]
    asked, nos_asked, places_asked = keys[asks], nos[asks], places[asks]
    rows = []
    for a, b in zip(*runs(part)):
        rows.append((int(part[a]), asked[a:b].tobytes(), pack(np.concatenate([nos_asked[a:b], places_asked[a:b]]))))
    tops = top[nos[later] != nos[top]]
    if again:
        linked = places[later] & 1 > 0
        later, to = later[linked], to[linked]
    found = nos[later], places[later], nos[to], places[to]
    return rows, found if again else _with_owned(found, nos, places, tops)


def _with_owned(found, nos, places, tops) -> tuple:
    """Matches, and for each first occurrence that other texts match one with itself, at place -1."""
    tops = np.unique(tops)
    owned = nos[tops], places[tops], nos[tops], np.full(len(tops), -1)
    return tuple(map(np.concatenate, zip(found, owned)))


def _dealt(parts: int, nos, places, other_nos, other_places) -> pa.RecordBatch:
    """Matches in one row for each part that texts are dealt to."""
    part = nos % parts
    order = _by_place(part, nos, places)
    columns = np.stack([nos, places, other_nos, other_places])[:, order]
    start, end = runs(part[order])
    data = [pack(columns[:, a:b].ravel()) for a, b in zip(start.tolist(), end.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(part[order][start], pa.int32()), pa.array(data, pa.binary())], names=["part", "known"])


def _each_part(work):
    """``work`` on the rows of one part after the other, which come sorted: a partition may hold several parts, a task only one at a time."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for a, b in zip(*runs(parts)):
                if held and parts[a] != current:
                    yield from work(held)
                    held = []
                current = parts[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from work(held)

    return each


def _by_part(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "part").sortWithinPartitions("part")


def _answer(parts: int, again: bool = False):
    """Matches with the first text that has the seed, and those known already, dealt to ``parts`` parts of texts."""

    def work(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], []
        for batch in batches:
            for keys, at, sure in ((x.as_py() for x in row) for row in zip(*(batch.column(c) for c in ("keys", "at", "known")))):
                if sure:
                    known.append(unpack(sure).reshape(4, -1))
                else:
                    held.append((np.frombuffer(keys, "<u8"), *unpack(at).reshape(2, -1)))
        if held:
            keys, nos, places = map(np.concatenate, zip(*held))
            held.clear()
            order = _by_key(keys, nos, places)
            keys, nos, places = keys[order], nos[order], places[order]
            start, end = runs(keys)
            top = np.repeat(start, end - start)
            other = nos != nos[top]
            asks = other & (places & 1 > 0) if again else other
            some = tuple(c[asks] for c in (nos, places, nos[top], places[top]))
            known.append(np.stack(some if again else _with_owned(some, nos, places, top[other])))
        if known:
            yield _dealt(parts, *np.concatenate(known, axis=1))

    return _each_part(work)


def _texts(batches: list[pa.RecordBatch]) -> Iterator[tuple]:
    """(number, places, other numbers, other places) of each text, sorted by place."""
    known = [unpack(x.as_py()).reshape(4, -1) for batch in batches for x in batch.column("known")]
    columns = np.concatenate(known, axis=1)
    known.clear()
    columns = columns[:, _by_place(np.zeros(columns.shape[1], np.int64), columns[0], columns[1])]
    for a, b in zip(*(x.tolist() for x in runs(columns[0]))):
        yield int(columns[0][a]), *columns[1:, a:b]


def _chained(again: bool):
    """The chains of the texts of each part, from all matches of a text."""

    def work(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chains(_texts(batches), again)

    return _each_part(work)


def matches(texts: DataFrame, parts: int) -> DataFrame:
    """Chains of the matches (places, texts and places of first occurrences) of seeds that are in several texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, bounds = text_bytes(part.column("text"))
                hashes, text, _, _ = words_of(data, bounds)
                keys, places = seeds(hashes, text)
                own = text[places]
                held.append((part.column("no").to_numpy()[own], keys, places - np.searchsorted(text, own)))
                size += len(keys)
                if size >= DEAL_SEEDS:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    def send(held: list[tuple]) -> pa.RecordBatch:
        return _sent(parts, held, False)

    dealt = _by_part(texts.mapInArrow(ask, ASKED), parts)
    answered = _by_part(dealt.mapInArrow(_answer(parts), "part int, known binary"), parts)
    return answered.mapInArrow(_chained(False), CHAINS)


def _sent(parts: int, held: list[tuple], again: bool) -> pa.RecordBatch:
    """What a block asks, by part, and in one row more the matches known; any part may deal these."""
    rows, known = _ask(parts, *map(np.concatenate, zip(*held)), again)
    rows = [(*r, None) for r in rows]
    if rows and len(known[0]):
        order = _by_place(np.zeros(len(known[0]), np.int64), known[0], known[1])
        rows.append((rows[0][1][0] % parts, None, None, pack(np.stack(known)[:, order].ravel())))
    kinds = [pa.int32(), *[pa.binary()] * 3]
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "keys", "at", "known"])


# ---- the second look ---------------------------------------------------------------------------------------------------


def _zones(words: int, spans: list[dict], done: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """(number of the stretch or 0, whether it asks) of each word of a text: a stretch asks around the K words or more that no passage has."""
    zone, asks, covered = np.zeros(words, np.int64), np.zeros(words, bool), np.zeros(words + 1, np.int64)
    for d in done or ():
        covered[d["begin_word"]] += 1
        covered[d["end_word"]] -= 1
    covered = np.cumsum(covered)[:-1] > 0
    for number, s in enumerate(spans, 1):
        zone[max(0, s["a0"] - K - REACH) : s["a1"] + K + REACH] = number
        starts, ends = runs(covered[s["a0"] : s["a1"]])
        for a, b in zip((starts + s["a0"]).tolist(), (ends + s["a0"]).tolist()):
            if b - a >= K and not covered[a]:
                asks[max(0, a - FLANK) : b + FLANK] = True
    return zone, asks & (zone > 0)


def pairs(hashes: np.ndarray, keys: np.ndarray, places: np.ndarray, zone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first place, distance) of the pairs of seeds of a stretch, SHORT to PAIRED words apart, and of its windows of LEAST_WORDS words."""
    some = zone[places] > 0
    keys, places = keys[some], places[some]
    found, step = [], 1
    index = np.arange(len(places) - 1)
    while len(index):
        far = places[index + step] - places[index]
        index, far = index[far <= PAIRED], far[far <= PAIRED]
        good = (far >= SHORT - K) & (zone[places[index]] == zone[places[index + step]])
        own = index[good]
        found.append((phrases.mixed(keys[own], keys[own + step]), places[own], far[good]))
        step += 1
        index = index[index + step < len(places)]
    if len(hashes) >= LEAST_WORDS:
        whole, size = hashes, 1
        while 2 * size <= LEAST_WORDS:
            whole, size = phrases.mixed(whole[: len(whole) - size], whole[size:]), 2 * size
        start = np.arange(len(hashes) - LEAST_WORDS + 1)
        start = start[(zone[start] > 0) & (zone[start] == zone[start + LEAST_WORDS - 1])]
        found.append((phrases.mixed(whole[start], whole[start + LEAST_WORDS - size]), start, np.full(len(start), WINDOW)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(map(np.concatenate, zip(*found)))


def _mark_copied(copied: np.ndarray, first: int, done: list[dict] | None) -> None:
    """For each word the word behind the longest exact copy of an earlier text around it. Near the ends of a passage other seeds may
    be taken, so these do not count."""
    for d in done or ():
        a, b = first + d["begin_word"] + K + REACH, first + d["end_word"] - K - REACH
        if d["similarity"] >= 1 and a < b:
            np.maximum(copied[a:b], b, out=copied[a:b])


def _asking(keys: np.ndarray, text: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """Whether a key asks: all places of it in a text do if one does."""
    out = np.zeros(len(keys), bool)
    some = np.flatnonzero(np.isin(text, np.unique(text[asks])))
    if len(some):
        _, same = np.unique(phrases.mixed(keys[some], text[some]), return_inverse=True)
        out[some] = (np.bincount(same, asks[some]) > 0)[same]
    return out


def matches_again(texts: DataFrame, parts: int) -> DataFrame:
    """Chains of the matches of pairs of seeds and of whole windows, for ``texts`` with their stretches of shared seeds (spans) and passages (done).

    There are more keys than in the first look, dealt to ``KEY_PARTS`` times the parts, but few matches: those go to ``parts`` parts.
    """
    key_parts = KEY_PARTS * parts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                data, bounds = text_bytes(part.column("text"))
                hashes, text, _, _ = words_of(data, bounds)
                begins = np.searchsorted(text, np.arange(part.num_rows + 1))
                zones, asks, most = [], [], 0
                copied = np.zeros(len(hashes) + 1, np.int64)
                for k, (spans, done) in enumerate(zip(part.column("spans").to_pylist(), part.column("done").to_pylist())):
                    zone, asking = _zones(int(begins[k + 1] - begins[k]), spans, done)
                    zones.append(np.where(zone > 0, zone + most, 0))
                    asks.append(asking)
                    most += len(spans)
                    _mark_copied(copied, int(begins[k]), done)
                keys, start, far = pairs(hashes, *seeds(hashes, text), np.concatenate(zones))
                asking = _asking(keys, text[start], np.concatenate(asks)[start])
                # What an earlier text has word for word can belong to that one only, and it sends it.
                behind = start + np.where(far == WINDOW, LEAST_WORDS, far + K)
                needed = asking | (copied[start] < behind)
                keys, start, far, asking = keys[needed], start[needed], far[needed], asking[needed]
                own = text[start]
                code = ((start - begins[own]) * 128 + far) * 2 + asking
                held.append((part.column("no").to_numpy()[own], keys, code))
                size += len(keys)
                if size >= DEAL_SEEDS:
                    yield _sent(key_parts, held, True)
                    held, size = [], 0
        if size:
            yield _sent(key_parts, held, True)

    dealt = _by_part(texts.mapInArrow(ask, ASKED), key_parts)
    answered = _by_part(dealt.mapInArrow(_answer(parts, True), "part int, known binary"), parts)
    return answered.mapInArrow(_chained(True), CHAINS)


def _anchors(place: np.ndarray, nos: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of seeds from those of pairs and windows."""
    place, far, other, other_far = place >> 8, place >> 1 & 127, other >> 8, other >> 1 & 127
    whole = far == WINDOW
    first = -place[whole] % K  # the same places from each of the windows that lie over each other
    steps = [(~whole, place, other), (~whole, place + far, other + other_far)]
    columns = [np.stack([p[w], nos[w], o[w]]) for w, p, o in steps]
    for k in range(0, LEAST_WORDS - K + 1, K):
        fits = first + k <= LEAST_WORDS - K
        w = np.flatnonzero(whole)[fits]
        columns.append(np.stack([place[w] + first[fits] + k, nos[w], other[w] + first[fits] + k]))
    return _distinct(*np.concatenate(columns, axis=1))


def _distinct(place: np.ndarray, nos: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each match once. One number for a match sorts much faster than a row of three."""
    if not len(place):
        return place, nos, other
    texts, code = _ranked(nos)
    span, width = int(place.max()) + 1, int(other.max()) + 1
    if len(texts) * span * width >= 1 << 62:
        first = np.unique(np.stack([code, place, other]), axis=1, return_index=True)[1]
        return place[first], nos[first], other[first]
    each = np.sort((code * span + place) * width + other)
    rest, other = np.divmod(each[np.concatenate([[True], each[1:] != each[:-1]])], width)
    code, place = np.divmod(rest, span)
    return place, texts[code], other


# ---- chains ------------------------------------------------------------------------------------------------------------


def _straight(at: np.ndarray, to: np.ndarray) -> bool:
    """Whether sorted matches lie on one diagonal and so close that each link pays: then they are one chain, each following the one before."""
    steps = np.diff(at)
    return len(at) == 1 or bool((steps > 0).all() and (steps < LOOSE).all() and (np.diff(to) == steps).all())


def chain(places: np.ndarray, others: np.ndarray, least: int = 0) -> list[list[int]]:
    """Collinear chains of matches, best first, each match in one at most; only those over ``least`` words or more.

    A chain grows on both sides; its score is K for each match less GAP_COST for each word between matches on either
    side. That cost is a difference of two sums, so the best match to follow is a maximum over the matches before it,
    which a Fenwick tree over the other side holds.
    """
    order = np.lexsort((others, places))
    places, others = places[order], others[order]
    if len(order) and _straight(places, others):
        return [order.tolist()] if places[-1] + K - places[0] >= least else []
    at, cost = places.tolist(), (GAP_COST * (places + others)).tolist()
    ranks, rank = np.unique(others, return_inverse=True)
    rank, nodes = (rank + 1).tolist(), len(ranks) + 1
    most, holder = [float("-inf")] * nodes, [-1] * nodes
    top, top_rank, single = float("-inf"), nodes, True  # the largest entry, its rank, and whether no other is as large
    top_holder = -1
    score, before = [K] * len(at), [-1] * len(at)
    ready = 0  # matches of the same place must not follow each other
    for i, (here, paid) in enumerate(zip(at, cost)):
        if at[ready] != here:
            for j in range(ready, i):
                entry, r = score[j] + cost[j], rank[j]
                if entry > top:
                    top, top_rank, top_holder, single = entry, r, j, True
                elif entry == top:
                    single = False
                while r < nodes and most[r] < entry:  # nodes above hold no less
                    most[r], holder[r] = entry, j
                    r += r & -r
            ready = i
        r = rank[i] - 1
        if single and top_rank <= r:
            best, follows = top, top_holder
        else:
            best, follows = float("-inf"), -1
            while r:
                if most[r] > best:
                    best, follows = most[r], holder[r]
                r &= r - 1
        gain = best - paid
        if gain > 0:
            score[i], before[i] = K + gain, follows
    used, out = [False] * len(at), []
    for i in sorted(range(len(at)), key=score.__getitem__, reverse=True):
        if used[i]:
            continue
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = before[i]
        if at[links[0]] + K - at[links[-1]] >= least:
            out.append(order[links[::-1]].tolist())
    return out


CHAINS = "no long, other_no long, anchors binary, a0 long, a1 long, b0 long, b1 long"


def _stretches(places: np.ndarray) -> list[tuple[int, int]]:
    """(first word, word behind) of the stretches of shared seeds that are long enough to be part of a passage."""
    if places.max() + K - places.min() < SHORT:
        return []
    places = np.unique(places)
    cuts = np.flatnonzero(np.diff(places) > LOOSE) + 1
    ends = zip(places[np.concatenate([[0], cuts])], places[np.concatenate([cuts, [len(places)]]) - 1])
    return [(int(a), int(b) + K) for a, b in ends if b + K - a >= SHORT]


def _last_at(places: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the last of the sorted places that equals it, whether there is one) for each place wanted."""
    if not len(places):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    index = np.maximum(np.searchsorted(places, wanted, side="right") - 1, 0)
    return index, places[index] == wanted


def _chains(texts: Iterator[tuple], again: bool = False) -> Iterator[pa.RecordBatch]:
    """Chains long enough to be part of a passage, with the windows of words that their alignment needs; in rows without anchors the
    stretches of seeds that other texts have as well, unless it is the second look."""
    out = []
    for no, place, nos, other in texts:
        own = nos == no  # further places of a seed in this text take the matches of its first place
        theirs, mine = np.flatnonzero(~own), np.flatnonzero(own)
        if not again and len(mine):
            owned = other[mine] < 0
            shared = place[~own | (other < 0)]
            mine = mine[~owned]
            repeated = mine[_last_at(shared, other[mine])[1]]
            shared = np.concatenate([shared, place[repeated]])
        elif not again:
            shared = place
        if not again and len(shared):
            out += [(no, None, None, a, b, None, None) for a, b in _stretches(shared)]
        if len(theirs):
            out += _of_text(no, place, nos, other, theirs, mine, again)
        if len(out) >= 2_000:
            yield _chain_rows(out)
            out = []
    if out:
        yield _chain_rows(out)


def _of_text(no: int, place, nos, other, theirs, mine, again: bool) -> list[tuple]:
    """The chains of a text to each other one, from the matches with others (``theirs``) and with itself (``mine``)."""
    out = []
    if len(mine):
        index, there = _last_at(place[theirs], other[mine])
        place = np.concatenate([place[theirs], place[mine[there]]])
        theirs = np.concatenate([theirs, theirs[index[there]]])
    else:
        place = place[theirs]
    nos, other = nos[theirs], other[theirs]
    if again:
        place, nos, other = _anchors(place, nos, other)
    order = np.argsort(nos, kind="stable")
    start, end = runs(nos[order])
    long = np.maximum.reduceat(place[order], start) + K - np.minimum.reduceat(place[order], start) >= SHORT
    for a, b in zip(start[long].tolist(), end[long].tolist()):
        some = order[a:b]
        both = np.stack([place[some], other[some]])
        for links in chain(*both, SHORT):
            anchors = both[:, links].astype("<i4")
            (first, last), (other_first, other_last) = anchors[:, [0, -1]].tolist()
            window = [_down(first), _up(last), _down(other_first), _up(other_last)]
            out.append((no, int(nos[some[0]]), anchors.tobytes(), *window))
    return out


def _chain_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 2 + [pa.binary()] + [pa.int64()] * 4
    names = [c.split()[0] for c in CHAINS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _down(place: int) -> int:
    return max(0, (int(place) - FLANK // 2) // FLANK * FLANK)


def _up(place: int) -> int:
    return -(-(int(place) + K + FLANK // 2) // FLANK) * FLANK


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short hashes of the words of the windows asked for."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            data, bounds = text_bytes(part.column("text"))
            hashes, text, _, _ = words_of(data, bounds)
            begins = np.searchsorted(text, np.arange(part.num_rows + 1))
            no, a, b, short = [], [], [], []
            for k, (n, wanted) in enumerate(zip(part.column("no").to_pylist(), part.column("wanted").to_pylist())):
                own = (hashes[begins[k] : begins[k + 1]] >> np.uint64(40)).astype("<u2")
                for w in wanted:
                    no.append(n)
                    a.append(w["a"])
                    b.append(w["b"])
                    short.append(own[w["a"] : w["b"]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(no, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(short, pa.binary())],
                names=["no", "a", "b", "words"],
            )


# ---- alignment ---------------------------------------------------------------------------------------------------------


def same_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words that the best alignment of two short runs has in common."""
    return _same_words(a.tolist(), b.tolist())


def _same_words(a: list[int], b: list[int]) -> int:
    if a == b:
        return len(a)
    begin, end = 0, min(len(a), len(b))
    while begin < end and a[begin] == b[begin]:
        begin += 1
    behind = 0
    while behind < end - begin and a[-1 - behind] == b[-1 - behind]:
        behind += 1
    ends, a, b = begin + behind, a[begin : len(a) - behind], b[begin : len(b) - behind]
    if not a or not b:
        return ends
    # A row of the table of common lengths as one number, a bit for each place where it does not grow.
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for y in b:
        if y in places:
            same = row & places[y]
            row = ((row + same) | (row - same)) & every
    return ends + len(a) - row.bit_count()


def _extended(a: list[int], b: list[int], i: int, j: int, step: int) -> tuple[int, int]:
    """(how far two runs go together from words i and j on, words in common there): a word in common counts 1, others cost 2, and 6 below the
    best ends it."""
    value = best = far = 0
    n = min(len(a) - i, len(b) - j) if step > 0 else min(i, j) + 1
    for k in range(n):
        if a[i] == b[j]:
            value += 1
            if value > best:
                best, far = value, k + 1
        else:
            value -= 2
            if value < best - 6:
                break
        i += step
        j += step
    return far, (best + 2 * far) // 3


def align(a: np.ndarray, b: np.ndarray, at: np.ndarray, to: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(begin, end, other begin, other end, similarity) of the passages of a chain.

    ``a`` and ``b`` are the words of the windows, ``at`` and ``to`` the places of the seeds in them. What lies between seeds is aligned, the
    ends are extended, and the chain is cut where less than half of a gap of over K words agrees.
    """
    out, begin, same = [], 0, 0
    pieces, gaps = [], []
    a, b, at, to = a.tolist(), b.tolist(), at.tolist(), to.tolist()
    for i in range(len(at) - 1):
        gap_a, gap_b = a[at[i] : at[i + 1]], b[to[i] : to[i + 1]]
        wide = len(gap_a)
        if gap_a == gap_b:
            gaps.append((wide, wide, wide))
            same += wide
            continue
        common = _same_words(gap_a, gap_b)
        gaps.append((common, wide, len(gap_b)))
        wide = max(wide, len(gap_b))
        if wide > 2 * K and 2 * common < wide:
            pieces.append((begin, i, same))
            begin, same = i + 1, 0
        else:
            same += common
    pieces.append((begin, len(at) - 1, same))
    for first, last, same in pieces:
        left, same_left = _extended(a, b, at[first] - 1, to[first] - 1, -1)
        end_a, end_b = at[last] + K, to[last] + K
        right, same_right = _extended(a, b, end_a, end_b, 1)
        box = at[first] - left, end_a + right, to[first] - left, end_b + right
        similarity = (same + K + same_left + same_right) / max(box[1] - box[0], box[3] - box[2])
        if box[1] - box[0] >= LEAST_WORDS and similarity >= SIMILARITY:
            out.append((*box, min(1.0, similarity)))
        elif box[1] - box[0] >= LEAST_WORDS:
            ends = (same_left, left, left), (K + same_right, K + right, K + right)
            if _may_have_parts([ends[0], *gaps[first:last], ends[1]]):
                out += best_parts(a, b, at[first : last + 1], to[first : last + 1], box)
    return out


def _may_have_parts(gaps: list[tuple[int, int, int]]) -> bool:
    """Whether ``best_parts`` can find a passage, by the words in common and the lengths of the gaps in a row.

    Of the gaps that a passage has in part it takes no more words than they have in common, and each of those adds at most 1 - SIMILARITY to what
    the passage has in common over SIMILARITY of a side; a gap within it adds what it has over that.
    """
    least = SIMILARITY * LEAST_WORDS - 1e-6
    if any(common >= least for common, _, _ in gaps):
        return True
    common, *sides = (np.array(c, np.float64) for c in zip(*gaps))
    total = np.cumsum(common)
    ends = np.searchsorted(total, total - common + least)  # first gap with which there are enough words
    starts = np.flatnonzero(ends < len(gaps))
    for side in sides:
        over = np.cumsum(common - SIMILARITY * side)
        until = over - (common - SIMILARITY * side) + (1 - SIMILARITY) * common  # to the last word of a gap
        reach = np.maximum.accumulate(until[::-1])[::-1]
        starts = starts[reach[ends[starts]] >= (over - (1 - SIMILARITY) * common)[starts] - 1e-6]
    return len(starts) > 0


def common_places(first: list[int], second: list[int]) -> list[tuple[int, int]]:
    """Places of the words that the best alignment of two short runs has in common."""
    if first == second:
        return [(i, i) for i in range(len(first))]
    out, i, j = [], len(first), len(second)
    while i and j and first[i - 1] == second[j - 1]:
        i, j = i - 1, j - 1
        out.append((i, j))
    # The rows of the table of common lengths as in ``_same_words``; a bit is set where going back loses nothing.
    places: dict[int, int] = {}
    for k, x in enumerate(first[:i]):
        places[x] = places.get(x, 0) | 1 << k
    every = (1 << i) - 1
    rows = [every]
    for y in second[:j]:
        row = rows[-1]
        same = row & places.get(y, 0)
        rows.append(((row + same) | (row - same)) & every if same else row)
    while i and j:
        if first[i - 1] == second[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def best_parts(a: list[int], b: list[int], at: list[int], to: list[int], box: tuple[int, int, int, int]) -> list[tuple[int, int, int, int, float]]:
    """Passages within the box of a chain that as a whole is not alike enough: of the runs between two words in common that are long and
    alike enough the longest one, then the same on both sides of it."""
    left = min(at[0] - box[0], to[0] - box[2])
    same = [(at[0] - k, to[0] - k) for k in range(left, 0, -1) if a[at[0] - k] == b[to[0] - k]]
    for i in range(len(at) - 1):
        same += [(at[i] + x, to[i] + y) for x, y in common_places(a[at[i] : at[i + 1]], b[to[i] : to[i + 1]])]
    end = min(box[1] - at[-1], box[3] - to[-1])
    same += [(at[-1] + k, to[-1] + k) for k in range(end) if a[at[-1] + k] == b[to[-1] + k]]
    x, y = (np.array(c, np.int64) for c in zip(*same))
    order = np.arange(len(x))
    # The longer side from word i to word j is at most (j - i + 1) / SIMILARITY: both of these must not fall from i to j.
    rise_x, rise_y = order - SIMILARITY * x, order - SIMILARITY * y
    out, waiting = [], [(0, len(x))]
    while waiting:
        low, high = waiting.pop()
        best = (LEAST_WORDS - 1, -1, -1)
        # Largest values from each place on: beyond the last that is large enough no run can end.
        far_x, far_y = (np.maximum.accumulate(r[low:high][::-1]) for r in (rise_x, rise_y))
        least_x, least_y = rise_x[low:high] + SIMILARITY - 1 - 1e-9, rise_y[low:high] + SIMILARITY - 1 - 1e-9
        stops = high - np.maximum(np.searchsorted(far_x, least_x), np.searchsorted(far_y, least_y))
        most = x[np.maximum(stops - 1, 0)] + 1 - x[low:high]
        for i in np.argsort(-most, kind="stable").tolist():
            if most[i] <= best[0]:
                break
            begin = int(np.searchsorted(x[: stops[i]], x[low + i] + best[0]))  # longer runs only
            fits = np.flatnonzero((rise_x[begin : stops[i]] >= least_x[i]) & (rise_y[begin : stops[i]] >= least_y[i]))
            if len(fits):
                j = begin + int(fits[-1])
                best = int(x[j] + 1 - x[low + i]), low + i, j
        if best[1] >= 0:
            _, i, j = best
            out.append((int(x[i]), int(x[j]) + 1, int(y[i]), int(y[j]) + 1, float((j - i + 1) / max(x[j] + 1 - x[i], y[j] + 1 - y[i]))))
            waiting += [(low, i), (j + 1, high)]
    return sorted(out)


PASSAGES = "no long, other_no long, begin_word long, end_word long, other_begin long, other_end long, similarity double"


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["no", "other_no", "anchors", "a0", "b0", "words", "other_words"]
    for batch in batches:
        out = []
        columns = [batch.column(c) for c in names]  # row by row: windows of long texts are large
        for no, other, anchors, a0, b0, words, other_words in ((c[i].as_py() for c in columns) for i in range(batch.num_rows)):
            at, to = np.frombuffer(anchors, "<i4").reshape(2, -1)
            a, b = np.frombuffer(words, "<u2"), np.frombuffer(other_words, "<u2")
            for x0, x1, y0, y1, similarity in align(a, b, at - a0, to - b0):
                out.append((no, other, x0 + a0, x1 + a0, y0 + b0, y1 + b0, similarity))
        if out:
            kinds = [pa.int64()] * 6 + [pa.float64()]
            names_out = [c.split()[0] for c in PASSAGES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names_out)


def _keyed(docs: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """id, rid and text, with the key and other columns in ``row``."""
    rows = docs.select(F.col(text).alias("text"), F.struct(F.col(key).alias("key"), *others).alias("row"))
    rid = F.xxhash64("row.key", F.coalesce("text", F.lit("")))
    return rows.select(F.coalesce(F.col("row.key").cast("long"), F.lit(int(NO_ID))).alias("id"), rid.alias("rid"), "text", "row")


def _kept(df: DataFrame, label: str, buckets: int = 0) -> DataFrame:
    """``stored``, by rid in so many buckets if asked; what the write has shuffled goes at its end, not when the driver happens to collect its garbage."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return stored_buckets(df, label, buckets, "rid") if buckets else stored(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def _numbered(rows: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """(rid, id and number (no) of each text in the order of id and rid; the rows with no). Texts are dealt by rid once, into buckets, so that no later
    join by rid moves them, whatever its other side holds."""
    each = rows.groupBy("rid").agg(F.min("id").alias("id"))
    numbers = _kept(each.orderBy("id", "rid").withColumn("no", F.monotonically_increasing_id()), "numbers")
    buckets = max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # with fewer Spark would deal them again
    dealt = rows.drop("id").repartition(buckets, "rid")
    return numbers, _kept(dealt.join(numbers.select("rid", "no"), "rid"), "texts", buckets)


def find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passages of ``rows`` (id, rid, text and others), by rid; the rows stored in buckets by rid).

    A seed leads to its first text only, and those of one passage may lead to several texts of which none holds it. So stretches of shared
    seeds of which no passage is found are looked at again: pairs of seeds and whole windows of words lead to the first text that has
    those, among all stretches of shared seeds.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(size, PART_BYTES, rows.sparkSession.sparkContext.defaultParallelism)
    tasks = parts_for(size, PART_BYTES)  # small tables are one block, whatever the number of buckets
    numbers, whole = _numbered(rows, parts)
    texts = whole.select("rid", "no", F.coalesce("text", F.lit("")).alias("text"))

    def to_texts(some: DataFrame, how: str = "inner", left: DataFrame = texts) -> DataFrame:
        return left.join(some.join(numbers.select("no", "rid"), "no").drop("no"), "rid", how)

    chains = _kept(matches(texts.select("no", "text").coalesce(tasks), parts), "chains")
    linked = chains.filter("anchors is not null")
    spans = chains.filter("anchors is null").groupBy("no").agg(F.sort_array(F.collect_list(F.struct("a0", "a1"))).alias("spans"))
    found = _kept(_aligned(to_texts(_wanted(linked)), linked, "windows"), "passages-seeds")
    done = found.groupBy("no").agg(F.collect_list(F.struct("begin_word", "end_word", "similarity")).alias("done"))
    looked = to_texts(done, "left", to_texts(spans))
    more = _kept(matches_again(looked.select("no", "text", "spans", "done").coalesce(tasks), parts), "chains-again")
    both = found.union(_aligned(to_texts(_wanted(more)), more, "windows-again")).distinct()
    others = numbers.select(F.col("no").alias("other_no"), F.col("id").alias("other_id"))
    named = both.join(numbers.select("no", "rid"), "no").join(others, "other_no").drop("no", "other_no")
    return _kept(named, "passages"), whole


def _wanted(chains: DataFrame) -> DataFrame:
    """no with the windows of words (wanted) that the alignment of the chains needs."""
    asked = chains.select("no", F.struct(F.col("a0").alias("a"), F.col("a1").alias("b")).alias("w")).union(
        chains.select("other_no", F.struct(F.col("b0").alias("a"), F.col("b1").alias("b")))
    )
    return asked.distinct().groupBy("no").agg(F.collect_list("w").alias("wanted"))


def _aligned(texts: DataFrame, chains: DataFrame, label: str) -> DataFrame:
    """Passages of the chains, by the texts (no, text, wanted) that they need."""
    short = texts.select("no", "text", "wanted").mapInArrow(_windows, "no long, a long, b long, words binary")
    windows = _kept(short.dropDuplicates(["no", "a", "b"]), label)
    own = windows.select("no", F.col("a").alias("a0"), F.col("b").alias("a1"), "words")
    other = windows.select(
        F.col("no").alias("other_no"), F.col("a").alias("b0"), F.col("b").alias("b1"), F.col("words").alias("other_words")
    )
    both = chains.join(own, ["no", "a0", "a1"]).join(other, ["other_no", "b0", "b1"])
    return both.mapInArrow(_align_rows, PASSAGES)


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per passage that an earlier text (of smaller key) has as well: key, begin_word, end_word, other (its key), other_begin,
    other_end and similarity (words in common of the longer side).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A passage has ``LEAST_WORDS`` words or more and a similarity
    of ``SIMILARITY`` or more. Every occurrence but the first is reported, against the first one of its block of
    text and of all blocks, where seeds, pairs of seeds or windows lead to it; so none is compared with all others. Texts that are equal and have equal keys are one text. A null
    key is null in the result and comes last. Null, blank and short texts have no passage; other columns are not read.
    """
    found, rows = find(_keyed(docs, key, text))
    keys = rows.select("rid", "row.key").distinct()
    other = F.when(F.col("other_id") == int(NO_ID), None).otherwise(F.col("other_id"))
    return found.join(keys, "rid").select(
        F.col("key").alias(key), "begin_word", "end_word", other.alias("other"), "other_begin", "other_end", "similarity"
    )


def cut_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the repeated passages; a text of which no word is left goes. Texts without passages stay as they are."""
    columns = docs.columns
    found, rows = find(_keyed(docs, key, text, *(c for c in columns if c not in (key, text))))
    spans = found.groupBy("rid").agg(F.collect_list(F.struct("begin_word", "end_word")).alias("__spans"))
    back = [F.col("text" if c == text else "row.key" if c == key else f"row.`{c}`").alias(c) for c in columns]
    joined = rows.join(spans, "rid", "left").select(*back, "__spans")
    hit = joined.filter(F.col("__spans").isNotNull())
    clean = joined.filter(F.col("__spans").isNull()).select(*columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, kept = [], []
            for row, (body, spans) in enumerate(zip(batch.column(text).to_pylist(), batch.column("__spans").to_pylist())):
                raw = np.frombuffer(body.encode(), np.uint8)
                _, _, first, behind = words_of(raw, np.array([0, len(raw)]))
                gone = np.zeros(len(first) + 1, np.int64)
                for s in spans:
                    gone[s["begin_word"]] += 1
                    gone[s["end_word"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                if gone.all():
                    continue
                starts, ends = runs(gone)
                cuts = [raw[first[a] if a else 0 : first[b] if b < len(first) else len(raw)] for a, b in zip(starts, ends) if not gone[a]]
                kept.append(row)
                out.append(b"".join(c.tobytes() for c in cuts).decode())
            some = batch.take(pa.array(kept, pa.int64()))
            arrays = [pa.array(out, pa.string()) if c == text else some.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return clean.unionByName(hit.mapInArrow(work, docs.schema))
