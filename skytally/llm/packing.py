"""Packing documents into sequences by the sum-of-squares rule, in shards of bounded size."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytally.llm.common import parts_for, per_worker, slices, stored

SLICE_BYTES = 4 << 20
MOST_CACHED = 1_000_000  # words a worker remembers
SHARD_PIECES = 8192  # pieces one task packs together
FULL = 0.98  # sequences filled less are opened and packed again, with those of other shards

PIECES = "piece int, start long, length long, ids_crc32 long"


# In a text of these characters only, lower-casing and composing (the normaliser's work) change nothing more
# once str.lower() is done, and a comma or full stop behind a letter or digit and before a space is a pre-token.
ODD_STOP = re.compile(r"[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ][.,] ")

LETTERS = re.compile(r"[a-zß-öø-ÿ]+")


class Words:
    """Token ids of texts, looked up by word: neither the normaliser nor the pre-tokeniser of the file
    looks across a space or a line feed, so a text's ids are those of its words in a row."""

    def __init__(self, path: str, most: int = MOST_CACHED):
        self.most = most
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}  # by word; full once the frequent words are in

    def split(self, text: str) -> list[str]:
        text = text.replace("\n", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split(" ")
        if not ODD_STOP.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.lower().split(" ")

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Letters only is one pre-token, whose last id ends a word: many of them are encoded in one go."""
        single = [w for w in words if LETTERS.fullmatch(w)]
        known = {}
        for at in range(0, len(single), 500):
            some = single[at : at + 500]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError("the vocabulary does not end each word with an end-of-word token")
            known.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, [0, *cuts[:-1].tolist()], cuts.tolist()))
        others = [w for w in words if w not in known]
        found = self.tokenizer.encode_batch(others, add_special_tokens=False)
        known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(others, found))
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        new = self.learn(list(set().union(*split).difference(self.cache)))
        known = self.cache
        if len(known) + len(new) > self.most:
            known = ChainMap(new, known)
        else:
            known.update(new)
        return [b"".join(map(known.__getitem__, words)) for words in split]


def pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", most_cached: int = MOST_CACHED,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """key, piece, start, length, ids_crc32: the token runs to be packed, cut where a document exceeds ``capacity``."""
    docs = docs.select(key, text)
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker(f"words {path} {most_cached}", lambda: Words(path, most_cached))
        for batch in batches:
            for part in slices(batch, text, slice_bytes):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(words.encode([x or "" for x in part.column(text).to_pylist()])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        run = ids[at : at + 4 * capacity]
                        row.append(i)
                        piece.append(number)
                        start.append(at // 4)
                        length.append(len(run) // 4)
                        crc.append(zlib.crc32(run))
                arrays = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = [key, "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(row, pa.int64())), *arrays], names=names)

    return docs.mapInArrow(work, f"`{key}` {kind}, {PIECES}")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, taken in the given order.

    Of the open bins that hold the item, it goes to the residual gap for which the sum over all gaps of the squared number of
    open bins becomes smallest; of equal ones to the tightest gap. Only if none holds it a bin is opened.
    """
    counts = np.zeros(capacity + 1)  # open bins by residual gap
    counts[0] = -0.5  # a closed bin leaves the sum: one less than moving it to an empty gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = itertools.count()
    for i, size in enumerate(lengths.tolist()):
        change = counts[: capacity + 1 - size] - counts[size:]
        change[counts[size:] <= 0] = np.inf
        at = int(change.argmin())
        if change[at] == np.inf:
            gap, number = capacity, next(opened)
        else:
            gap = at + size
            number = by_gap[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = number, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            by_gap[gap - size].append(number)
    return bins, offsets


def _pack_shard(capacity: int, names: list[str]):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "at"], ascending=[False, True], ignore_index=True)
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = rows["shard"] * (1 << 32) + bins
        rows["offset"] = offsets
        rows["filled"] = rows.groupby("sequence_id")["length"].transform("sum")
        return rows[names]

    return pack


def pack(sized: DataFrame, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """All columns of ``sized`` with sequence_id and offset; ``length`` is at most ``capacity``.

    Pieces are dealt to shards by their place in the stored table, whatever they hold, and each
    shard is packed from the longest piece down. What lies in sequences filled less than ``FULL`` is dealt
    again to fewer shards, until one shard holds it or a round no longer helps.
    """
    columns = sized.columns
    names = [*columns, "sequence_id", "offset", "filled", "at"]
    rest = stored(sized.withColumn("at", F.monotonically_increasing_id()), "pieces")
    schema = sized.withColumns({n: F.lit(0).cast("long") for n in names[len(columns) :]}).schema
    done, first, left = [], 0, rest.count()
    while True:
        shards = parts_for(left, shard_pieces)
        dealt = rest.withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(shards)) + first)
        packed = stored(dealt.groupBy("shard").applyInPandas(_pack_shard(capacity, names), schema), "packed")
        first += shards
        loose = packed.filter(F.col("filled") < FULL * capacity)
        if shards == 1 or (now := loose.count()) > 0.5 * left:
            return _union([*done, packed]).select(*columns, "sequence_id", "offset")
        done.append(packed.filter(F.col("filled") >= FULL * capacity))
        rest, left = loose.select(*columns, "at"), now


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, key: str = "doc_id", text: str = "text", most_cached: int = MOST_CACHED,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of a document.

    A document is its token ids with ``end_id`` behind them; null or empty text is ``end_id`` alone. Repeated rows are
    packed each for itself, ties in length go by place in the table, no rows give no rows, and other
    columns are not read. ``most_cached`` words are remembered by each worker and ``slice_bytes`` of text encoded at a
    time: less takes less memory and more time.
    """
    return pack(pieces(docs, path, end_id, capacity, key, text, most_cached, slice_bytes), capacity)
