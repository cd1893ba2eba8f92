"""Importance resampling towards a target: hashed word features, each distinct line of the corpus counted once."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import slices, stored, text_bytes

BUCKETS = 10_000
SLICE_BYTES = 4 << 20
LONG = 64  # bytes; the rare longer words are hashed one by one

# Bytes of a word once A-Z are lower-cased: digits, a-z, and every byte of a character above ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True


def _byte_steps() -> np.ndarray:
    """What one byte does to the register of CRC-32."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


STEP = _byte_steps()


def _zero_shifts() -> np.ndarray:
    """[n, j, v]: the register v << 8j after n zero bytes. Checksums of two strings joined are a shift and an exclusive or."""
    out = np.zeros((LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG):
        out[n + 1] = (out[n] >> 8) ^ STEP[out[n] & 255]
    return out


SHIFT = _zero_shifts()


def _checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte runs, one byte of all of them at a time."""
    order = np.argsort(-np.minimum(lengths, LONG + 1), kind="stable")
    at, size = starts[order], lengths[order]
    value = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longer = int(np.searchsorted(-size, -LONG, side="left"))  # runs beyond LONG bytes come first
    for k in range(int(size[longer:].max(initial=0))):
        live = slice(longer, longer + int(np.searchsorted(-size[longer:], -k, side="left")))
        value[live] = (value[live] >> 8) ^ STEP[(value[live] ^ data[at[live] + k]) & 255]
    value ^= np.uint32(0xFFFFFFFF)
    for i in range(longer):
        value[i] = zlib.crc32(data[at[i] : at[i] + size[i]])
    out = np.empty_like(value)
    out[order] = value
    return out


class Words:
    """The words of some texts: their text, their line, and the checksums of them and of neighbours."""

    def __init__(self, column: pa.Array):
        raw, offsets = text_bytes(column)
        self.data = LOWER[raw]
        inside = IN_WORD[self.data]
        follows = np.zeros(len(inside) + 1, bool)  # the byte before belongs to the same word
        follows[1:] = inside
        follows[offsets] = False
        begins = inside & ~follows[:-1]
        ends = np.zeros(len(inside) + 1, bool)
        ends[:-1] = ~inside | begins
        ends[offsets] = True
        self.starts = np.flatnonzero(begins)
        stops = np.flatnonzero(ends)
        self.lengths = stops[np.searchsorted(stops, self.starts, side="right")] - self.starts
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(column))
        self.crc = _checksums(self.data, self.starts, self.lengths)

    def pairs(self, across_lines: bool) -> np.ndarray:
        """First words of the pairs within a line, or of those over a line feed."""
        same_text = self.text[1:] == self.text[:-1]
        line = np.searchsorted(np.flatnonzero(self.data == 10), self.starts)
        return np.flatnonzero(same_text & ((line[1:] != line[:-1]) == across_lines))

    def pair_checksums(self, first: np.ndarray) -> np.ndarray:
        """CRC-32 of word, space and next word."""
        value = self.crc[first] ^ np.uint32(0xFFFFFFFF)
        value = ((value >> 8) ^ STEP[(value ^ 32) & 255]) ^ np.uint32(0xFFFFFFFF)
        size = self.lengths[first + 1]
        n = np.minimum(size, LONG)
        out = self.crc[first + 1].copy()
        for j in range(4):
            out ^= SHIFT[n, j, (value >> np.uint32(8 * j)) & 255]
        for i in np.flatnonzero(size > LONG).tolist():
            a, b = first[i], first[i] + 1
            words = [self.data[self.starts[w] : self.starts[w] + self.lengths[w]].tobytes() for w in (a, b)]
            out[i] = zlib.crc32(b" ".join(words))
        return out


def _documents(key: str, buckets: int):
    """Per document its number of words and the buckets of the pairs that cross its lines; the keys of its lines go through."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = Words(part.column("text"))
                first = words.pairs(across_lines=True)
                found = (words.pair_checksums(first) % np.uint32(buckets)).astype(np.int32)
                ends = np.searchsorted(words.text[first], np.arange(part.num_rows + 1))
                cross = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found))
                columns = [part.column(key), pa.array(words.counts, pa.int64()), cross, part.column("lines")]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "crossing", "lines"])

    return work


def _line_features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, bucket) of every word and every pair of a line."""
    first = words.pairs(across_lines=False)
    found = np.concatenate([words.crc, words.pair_checksums(first)]) % np.uint32(buckets)
    return np.concatenate([words.text, words.text[first]]), found.astype(np.int64)


def _line_counts(buckets: int):
    """Counts by bucket of a task's lines, each line's features taken as often as the line occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "line", SLICE_BYTES):
                line, bucket = _line_features(Words(part.column("line")), buckets)
                times = part.column("times").to_numpy()
                order = np.argsort(bucket, kind="stable")
                bucket, many = bucket[order], times[line[order]]
                where = np.flatnonzero(np.diff(bucket, prepend=-1))
                if len(where):
                    total[bucket[where]] += np.add.reduceat(many, where)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return work


def _line_gains(gains: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "line", SLICE_BYTES):
                line, bucket = _line_features(Words(part.column("line")), len(gains))
                total = np.bincount(line, weights=gains[bucket], minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(total)], names=["a", "b", "gain"]
                )

    return work


def _crossing_gains(gains: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("crossing")
            sums = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            total = sums[ends[1:]] - sums[ends[:-1]]
            kept = [name for name in batch.schema.names if name != "crossing"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(total)], names=[*kept, "crossing_gain"])

    return work


def _line_key(line):
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


class Corpus:
    """A table of texts cut into lines: its documents without their texts, and its distinct lines with their number."""

    def __init__(self, docs: DataFrame, key: str, text: str, buckets: int, label: str):
        self.buckets = buckets
        docs = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
        cut = F.filter(F.split("text", "\n", -1), lambda line: line != "")
        kind = docs.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, n_words long, crossing array<int>, lines array<struct<a: long, b: long>>"
        keyed = docs.withColumn("lines", F.transform(cut, _line_key))
        lean = keyed.mapInArrow(_documents(key, buckets), schema)
        self.documents = stored(lean.withColumn("row", F.monotonically_increasing_id()), f"{label}-documents")
        lines = docs.select(F.explode(cut).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
        self.lines = stored(lines, f"{label}-lines")

    def counts(self) -> np.ndarray:
        """Features by bucket over all documents."""
        inside = self.lines.mapInArrow(_line_counts(self.buckets), "bucket long, n long")
        across = self.documents.select(F.explode(F.col("crossing").cast("array<long>")).alias("bucket"), F.lit(1).cast("long").alias("n"))
        total = np.zeros(self.buckets, np.int64)
        for row in inside.union(across).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
            total[row["bucket"]] = row["n"]
        return total


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """How much likelier each bucket is in the target, in thousandths of a nat, smoothed by one feature a bucket."""
    buckets = len(source)
    t_all, s_all = float(target.sum()) + buckets, float(source.sum()) + buckets
    pairs = zip(target.tolist(), source.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for t, s in pairs], np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """key, n_features, weight, score, rank (long): ``percent`` of the documents drawn with odds by their likeness to ``target``.

    A document's features are its words and its pairs of neighbouring words, by bucket of their CRC-32; ``weight`` is the floored
    mean of its buckets' gains, ``score`` adds Gumbel noise from a digest of the key, and of the documents with
    ``least_words`` or more the highest scores get a rank from 1. Texts are cut at line feeds: each distinct line's features are
    counted once and taken as often as it occurs; pairs over a line feed are added from the documents.

    Null and empty texts have no features: weight 0, never drawn. A null key is hashed as empty text and loses ties. Repeated rows are
    documents of their own, and their tie is settled by place in the table. An empty table gives no rows, an empty target leaves
    the gains to the source alone. Other columns are not read. A line that many documents share is one row of the lines and many of the
    join, whose hot partitions adaptive execution splits.
    """
    target_rows = target.select(F.lit(None).cast("long").alias("none"), F.col(target_text).alias("text"))
    source = Corpus(docs, key, text, buckets, "resample")
    gains = bucket_gains(Corpus(target_rows, "none", "text", buckets, "target").counts(), source.counts())

    keyed = source.lines.select("line", _line_key(F.col("line")).alias("k")).select("line", "k.*")
    line_gains = stored(keyed.mapInArrow(_line_gains(gains), "a long, b long, gain long"), "line-gains")
    kind = docs.schema[key].dataType.simpleString()
    documents = source.documents.mapInArrow(
        _crossing_gains(gains),
        f"`{key}` {kind}, n_words long, lines array<struct<a: long, b: long>>, row long, crossing_gain long",
    )
    own = ["row", key, "n_words", "crossing_gain"]
    each = documents.select(*own, F.explode_outer("lines").alias("k")).select(*own, "k.a", "k.b")
    gained = each.join(line_gains, ["a", "b"], "left").groupBy(*own).agg(F.coalesce(F.sum("gain"), F.lit(0)).alias("gain"))
    total, n = F.col("crossing_gain") + F.col("gain"), F.col("n_features")
    weighed = gained.select("row", key, "n_words", F.greatest(2 * F.col("n_words") - 1, F.lit(0)).alias("n_features"), total.alias("total"))
    exact = F.when(n > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.select("row", key, "n_words", "n_features", exact.alias("weight"), (exact + noise).alias("score"))
    scored = stored(scored, "resample-scored")

    counted = scored.agg(F.count_if(F.col("n_words") >= least_words).alias("n")).first()["n"]
    order = [F.desc("score"), F.asc_nulls_last(key), F.asc("row")]
    ranked = rank_all(scored.filter(F.col("n_words") >= least_words), order).filter(F.col("rank") <= percent * counted // 100)
    result = scored.join(ranked.select("row", "rank"), "row", "left")
    return result.select(key, "n_features", F.col("weight").cast("long").alias("weight"), F.col("score").cast("long").alias("score"), "rank")


def rank_all(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in one order over all of them, without bringing them to one task.

    Rows are dealt by ranges of the order and numbered within their range; what lies before a range is a sum over the ranges.
    """
    parts = rows.sparkSession.sparkContext.defaultParallelism
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33).cast("int")  # the id holds the partition above and the place in it below
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row a partition
    before, found = 0, []
    for size in sizes:
        found.append((size["part"], before))
        before += size["n"]
    starts = rows.sparkSession.createDataFrame(found, "part int, before long")
    joined = numbered.withColumn("part", part).join(F.broadcast(starts), "part")
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    return joined.withColumn("rank", F.col("before") + place + 1).drop("part", "before", "at")
