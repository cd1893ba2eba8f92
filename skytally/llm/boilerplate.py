"""Main text of pages: what a host's pages repeat is found by suffix arrays over their token streams, and goes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm import markup, phrases
from skytally.llm.common import each_group, pack, parts_for, runs, stored, unpack

DEPTH = 8  # tokens of a string that count as the same
CHUNK_CHARS = 2 << 20  # of HTML whose streams one suffix array orders
BUCKET_CHUNKS = 8  # chunks of a host whose strings one bucket unites
KEY_BITS = 36  # that tell the strings of a bucket at a place apart: of a million some fifteen are taken for another
SMALL = 200_000  # rows of a table that is sent to all tasks
LEAST_PAGES = 20  # distinct pages from which a host is judged by itself, else by the verdict over all such hosts
REPEATED = 0.5  # of a place's distinct strings, at least, are on two pages or more
REPEATED_INSIDE = 0.9  # the same for a place within an article
SPREAD_PAGES, SPREAD_SHARE = 3, 0.01  # and each is on so many pages on average

STREAM = "host long, page long, paths binary, sizes binary, tokens binary"


def host_of(url):
    """Lower-case host of a URL; null, or text that is none, has the empty one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def segments(page: str) -> list[tuple[int, list[str]]]:
    """The token stream of a page, cut where the place in the markup changes: (place, tokens)."""
    out: list[tuple[int, list[str]]] = []
    for block in markup.blocks(page):
        place = 2 * block.path + (block.inside > 0)
        if out and out[-1][0] == place:
            out[-1][1].extend(block.text.split())
        else:
            out.append((place, block.text.split()))
    return out


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the places, sizes and hashed tokens of its segments. Pages of equal longest segment are copies: ``page`` is its hash."""
    for batch in batches:
        rows, known = [], {}
        for page in batch.column("html").to_pylist():
            found = segments(page or "")
            words = [t for _, own in found for t in own]
            tokens = np.array([known.get(t) or known.setdefault(t, zlib.crc32(t.encode()) | 1) for t in words], np.uint32)
            sizes = np.array([len(own) for _, own in found], np.int32)
            most = int(sizes.argmax()) if len(sizes) else 0
            begin = int(sizes[:most].sum())
            longest = tokens[begin : begin + int(sizes[most])].tobytes() if len(sizes) else b""
            number = zlib.crc32(longest) | zlib.crc32(longest, 7) << 31
            places = np.array([place for place, _ in found], np.int64).tobytes()
            rows.append((number, places, sizes.tobytes(), tokens.tobytes()))
        columns = list(zip(*rows)) or [[], [], [], []]
        arrays = [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("host"), *arrays], names=["host", "page", "paths", "sizes", "tokens"])


def suffix_classes(tokens: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix in the order of its first ``depth`` tokens (a power of two); equal strings share a rank.

    ``room`` is the number of tokens up to the end of the suffix's segment, behind which nothing counts. The order of 2k tokens
    follows from that of k by prefix doubling.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    at, k = np.arange(len(tokens)), 1
    while k < depth:
        later = np.where(room > k, rank[np.minimum(at + k, len(tokens) - 1)], 0)
        rank = np.unique(rank * (len(tokens) + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        k *= 2
    return rank


def strings(pages: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, key, number of pages) of each distinct string at each place, in order of places.

    ``pages`` are (page, places, sizes, tokens) of one host, each page once. Strings are the runs of ``depth`` tokens within a
    segment, and whole segments that are shorter. A key follows from the string alone.
    """
    tokens = np.concatenate([p[3] for p in pages])
    if not len(tokens):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.concatenate([p[2] for p in pages]).astype(np.int64)
    places = np.repeat(np.concatenate([p[1] for p in pages]), sizes)
    page = np.repeat(np.arange(len(pages)), [len(p[3]) for p in pages])
    length = np.repeat(sizes, sizes)
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    room = begin + length - np.arange(len(tokens))
    string = suffix_classes(tokens, room, depth)
    starts = np.flatnonzero((room >= depth) | ((room == length) & (length < depth)))
    at = np.zeros(int(string.max()) + 1, np.int64)
    at[string] = np.arange(len(tokens))  # a place of each string
    # The pages of a string, then the strings of a place; a string at two places counts at each.
    names, code = np.unique(places, return_inverse=True)
    name, where = ordered(code[starts] * len(at) + string[starts], page[starts], len(pages).bit_length())
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (where[1:] != where[:-1])
    start, end = runs(name[new])
    name = name[new][start]
    at = at[name % len(at)]
    words = (np.where(room[at] > k, tokens[np.minimum(at + k, len(tokens) - 1)], 0).astype(np.uint64) for k in range(depth))
    return names[name // (int(string.max()) + 1)], phrases.mixed(*words), end - start


def ordered(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two numbers in order; ``low`` has so many bits. One number for both sorts much faster."""
    if len(high) and int(high.max()) >= 1 << 63 - bits:
        order = np.lexsort((low, high))
        return high[order], low[order]
    both = np.sort(high << bits | low)
    return both >> bits, both & (1 << bits) - 1


def _figures(place: np.ndarray, on_pages: np.ndarray) -> dict[int, tuple[int, int, int]]:
    out = {}
    for a, b in zip(*runs(place)):
        counts = on_pages[a:b]
        out[int(place[a])] = (int(b - a), int((counts > 1).sum()), int(counts.sum()))
    return out


def repeats(pages: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], depth: int = DEPTH) -> dict[int, tuple[int, int, int]]:
    """For each place: (distinct strings, those on two pages or more, pages summed over the strings) of ``strings``."""
    place, _, on_pages = strings(pages, depth)
    return _figures(place, on_pages)


EVIDENCE = "host long, bucket long, place long, pages long, strings long, again long, spread long, places binary, sizes binary, keys binary"
FIGURES = "host long, place long, pages long, strings long, again long, spread long"


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], names=[n for n, _ in names])


def _each_key(rows: pa.Table, *names: str) -> Iterator[tuple[int, int, pa.Table]]:
    """(first key, second key, rows) of each run of equal keys."""
    key = np.stack([rows.column(n).to_numpy() for n in names])
    cut = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [key.shape[1]]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(key[0, a]), int(key[1, a]), rows.slice(a, b - a)


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The figures of each place in each chunk, one row without a place for the chunk's pages, and if the host has more chunks its strings, dealt to buckets."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        out = []
        for host, chunk, some in _each_key(rows, "host", "chunk"):
            buckets = -(-some.column("chunks")[0].as_py() // BUCKET_CHUNKS)
            once, seen = {}, set()
            for page, *parts in zip(*(some.column(n).to_pylist() for n in ("page", "paths", "sizes", "tokens"))):
                once[page] = min(once.get(page, parts), parts)  # of pages that are copies the same one, wherever it stands
                seen.add(parts[0])
            pages = [(page, *(np.frombuffer(d, t) for d, t in zip(parts, ("<i8", "<i4", "<u4")))) for page, parts in once.items()]
            place, key, on_pages = strings(pages)
            found = _figures(place, on_pages)
            out.append((host, -1 - chunk, None, len(once), 0, 0, 0, None, None, None))
            # Places that only copies have: no evidence, but they are there.
            for at in {p for paths in seen for p in np.frombuffer(paths, "<i8").tolist()}:
                out.append((host, -1 - chunk, at, 0, *found.get(at, (0, 0, 0)), None, None, None))
            if some.column("chunks")[0].as_py() > 1:
                out += _dealt(host, buckets, place, key, on_pages > 1)
        yield _rows(out, EVIDENCE)

    yield from each_group(batches, ["host", "chunk"], work)


def _dealt(host: int, buckets: int, place: np.ndarray, key: np.ndarray, again: np.ndarray) -> Iterator[tuple]:
    """A row for each bucket: its strings as ``KEY_BITS`` of their keys, place by place, each with a bit that tells whether it is repeated in the chunk."""
    bucket = ((key & np.uint64((1 << 24) - 1)) % np.uint64(buckets)).astype(np.int64)
    code = (key >> np.uint64(64 - KEY_BITS)).astype(np.int64) << 1 | again
    names, name = np.unique(place, return_inverse=True)
    both, code = ordered(bucket * len(names) + name, code, KEY_BITS + 1)
    bucket, place = both // max(1, len(names)), names[both % max(1, len(names))]
    for a, b in zip(*runs(bucket)):
        start, end = runs(place[a:b])
        sizes = (end - start).astype("<i4").tobytes()
        yield host, int(bucket[a]), None, 0, 0, 0, 0, place[a:b][start].tobytes(), sizes, pack(code[a:b])


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The figures of the chunks, and what these count too often: a string of several chunks is one, and repeated."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for host, bucket, some in _each_key(rows, "host", "bucket"):
            if bucket < 0:
                yield from some.select([c.split()[0] for c in FIGURES.split(", ")]).to_batches()
                continue
            parts = list(zip(*(some.column(n).to_pylist() for n in ("places", "sizes", "keys"))))
            names, name = np.unique(np.concatenate([np.frombuffer(p, "<i8") for p, _, _ in parts]), return_inverse=True)
            sizes = np.concatenate([np.frombuffer(n, "<i4") for _, n, _ in parts])
            place, code = ordered(np.repeat(name, sizes), np.concatenate([unpack(k) for _, _, k in parts]), KEY_BITS + 1)
            key, again = code >> 1, code & 1
            start = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (key[1:] != key[:-1])]))
            chunks, repeated = np.diff(np.append(start, len(place))), np.add.reduceat(again, start)
            place, more = place[start], chunks - 1
            new = np.where(more > 0, 1 - repeated, 0)
            out = [(host, int(names[place[a]]), 0, -int(more[a:b].sum()), int(new[a:b].sum()), 0) for a, b in zip(*runs(place))]
            yield _rows(out, FIGURES)

    yield from each_group(batches, ["host", "bucket"], work)


def _is_repeated():
    inside = F.col("place") % 2 == 1
    share = F.when(inside, REPEATED_INSIDE).otherwise(REPEATED)
    return (F.col("strings") > 0) & (F.col("again") >= share * F.col("strings")) & (F.col("spread") >= F.col("needed"))


def repeated_places(pages: DataFrame) -> DataFrame:
    """host with the places that go on its pages, for ``pages`` of host, html: by the host's own verdict if it has enough pages, else those of its
    places that are repeated over all those hosts. Hosts without such a place have no row.

    A host's pages are dealt to chunks of bounded size by the hash of their longest segment, so copies of a page meet and count once.
    The figures of a place are sums over the chunks, less what several chunks have counted: they do not depend on how many chunks there are.
    """
    sizes = pages.groupBy("host").agg(F.sum(F.length("html")).alias("chars")).filter(F.col("chars") > CHUNK_CHARS)
    chunks = stored(sizes.select("host", F.ceil(F.col("chars") / CHUNK_CHARS).cast("int").alias("chunks")), "host-chunks")
    total = pages.agg(F.sum(F.length("html"))).first()[0] or 0
    streams = pages.mapInArrow(_streams, STREAM).join(sendable(chunks), "host", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = streams.withColumn("chunk", F.pmod("page", "chunks"))
    parts = parts_for(total, CHUNK_CHARS, pages.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt.repartition(parts, "host", "chunk").sortWithinPartitions("host", "chunk")
    strings_dealt = dealt.mapInArrow(_evidence, EVIDENCE).repartition(parts, "host", "bucket").sortWithinPartitions("host", "bucket")
    sums = [F.sum(c).alias(c) for c in ("pages", "strings", "again", "spread")]
    found = stored(strings_dealt.mapInArrow(_united, FIGURES).groupBy("host", "place").agg(*sums), "places")
    hosts = found.filter("place is null").select("host", "pages")
    needed = F.greatest(F.lit(float(SPREAD_PAGES)), SPREAD_SHARE * F.col("pages")) * F.col("strings")
    figures = found.filter("place is not null").drop("pages").join(hosts, "host").withColumn("needed", needed)
    judged = figures.filter(F.col("pages") >= LEAST_PAGES)
    totals = [F.sum(c).alias(c) for c in ("strings", "again", "spread", "needed")]
    overall = judged.groupBy("place").agg(*totals).filter(_is_repeated()).select("place")
    others = figures.filter(F.col("pages") < LEAST_PAGES).join(overall, "place", "left_semi")
    bad = judged.filter(_is_repeated()).select("host", "place").union(others.select("host", "place"))
    return stored(bad.groupBy("host").agg(F.collect_list("place").alias("places")), "repeated-places")


def sendable(small: DataFrame) -> DataFrame:
    """The stored table, marked to be sent to every task if it has at most ``SMALL`` rows; else Spark shuffles it."""
    return F.broadcast(small) if small.count() <= SMALL else small


def main_text(page: str, places: set[int]) -> tuple[str, int, int]:
    """(text, characters removed as repeated, characters removed by the markup) of one page."""
    found = markup.blocks(page)
    proper = [b for b in found if not b.around]
    level = max((b.inside for b in proper), default=0)
    proper = [b for b in proper if b.inside == level]
    kept = [b.text for b in proper if 2 * b.path + (b.inside > 0) not in places]
    repeated = [b for b in found if 2 * b.path + (b.inside > 0) in places]
    n_repeated = sum(len(b.text) for b in repeated)
    n_all = sum(len(b.text) for b in found)
    text = "\n\n".join(kept)
    return text, n_repeated, n_all - n_repeated - sum(map(len, kept))


def _texts(kept: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts: dict[int, set[int]] = {}
            out = []
            for page, host, places in zip(*(batch.column(c).to_pylist() for c in ("html", "host", "places"))):
                if host not in hosts:
                    hosts[host] = set(places or ())
                out.append(main_text(page or "", hosts[host]))
            texts, repeated, around = zip(*out) if out else ([], [], [])
            columns = [pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (map(len, texts), repeated, around))]
            names = [*kept, "text", "n_chars", "n_repeated", "n_around"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=names)

    return work


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text, n_chars, n_repeated, n_around (long): the article of every page as blocks parted by empty lines.

    A page is a stream of tokens, cut into segments by place: an element with its ancestors and the words of their classes. Suffix
    arrays over the streams of a host's distinct pages find the strings that several pages share. A place whose strings are
    mostly shared, and by many pages, holds boilerplate: its blocks go (``n_repeated`` characters). What pages of a copied or quoted
    article share does not make a place, as each distinct string counts once. Hosts of fewer than ``LEAST_PAGES`` distinct pages go by
    the places that are boilerplate over all other hosts. What cannot be found by repetition, such as reader comments, unique
    adverts and forms, goes by its elements, roles and class words, as does all outside of an article or a main part where a
    page has one (``n_around``). Nothing else is dropped: a block stays or goes as a whole.

    Null and empty pages, and pages without an article, have empty text. A null or odd URL belongs to the host without a name.
    Repeated rows each give a row, and count as one page. No rows give no rows, and other columns are not read.
    """
    columns = pages.select(F.col(key).alias(key), F.col(url).alias(url), F.col(html).cast("string").alias("html"))
    hosted = columns.withColumn("host", F.xxhash64(host_of(F.col(url))))
    places = repeated_places(hosted.select("host", "html"))
    joined = hosted.join(sendable(places), "host", "left")
    kinds = {f.name: f.dataType.simpleString() for f in columns.schema.fields}
    schema = f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long, n_repeated long, n_around long"
    return joined.select(key, url, "html", "host", "places").mapInArrow(_texts([key, url]), schema)
