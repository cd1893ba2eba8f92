"""SimHash near-duplicates: fingerprints that differ in few bits, found by segment popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import each_group, parted, parts_for, release_worker, row_key, stored
from skytally.llm.graph import components

SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits as a signed long: a bit is set when it is set in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()  # bytes.lower() touches A-Z only
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(min(shingle, len(words))))))
    hashes = map(xxhash.xxh64_digest, shingles, repeat(SEED))
    ones = np.zeros(64, np.int64)
    for _ in range(0, count, HASHES_AT_ONCE):
        block = np.frombuffer(b"".join(islice(hashes, HASHES_AT_ONCE)), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """All columns of ``docs`` but the text, with the fingerprint of the whole text in ``fp``."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept).withColumn("fp", F.lit(0).cast("long")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(found, pa.int64())], names=[*kept, "fp"]
            )

    return docs.mapInArrow(work, schema)


def segment_counts(bits: np.ndarray, width: int) -> np.ndarray:
    """Popcounts of the segments of ``width`` bits, one row per fingerprint."""
    segments = 64 // width
    shifts = np.arange(segments, dtype=np.uint64) * np.uint64(width)
    return np.bitwise_count((bits[:, None] >> shifts) & np.uint64((1 << width) - 1))


def cells(bits: np.ndarray, distance: int, width: int) -> np.ndarray:
    """Grid cells (one row per fingerprint) such that two fingerprints within ``distance`` share one.

    The bit counts of the segments embed the fingerprints: their Manhattan distance is at most the
    number of differing bits. Split into groups of segments, some group holds at most its share r of that
    distance, and then some point of the grid lies within ceil(r/2) steps of both.
    So each fingerprint takes its own cell of each group and those up to ceil(r/2) steps away.
    """
    counts = segment_counts(bits, width).astype(np.int64)
    groups = max(2, distance // 2)  # shares of 2 or 3 bits: one step reaches 2
    while distance // groups > 2:
        groups += 1
    out = []
    base = width + 3  # counts run from -1 to width + 1
    for number, own in enumerate(np.array_split(np.arange(counts.shape[1]), groups)):
        weight = np.array([base**k for k in range(len(own))], dtype=object)
        weight = np.array([int(w) & (2**64 - 1) for w in weight], np.uint64)
        code = ((counts[:, own] + 1).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
        near = [code]
        if distance // groups > 0:
            near += [code + w for w in weight] + [code - w for w in weight]
        mixed = np.stack(near, axis=1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number)
        out.append(mixed ^ (mixed >> np.uint64(29)))
    return np.concatenate(out, axis=1).view(np.int64)


def links(distinct: DataFrame, distance: int, width: int) -> DataFrame:
    """Verified links (a, b) that join what pairs within ``distance`` join; ``distinct`` has a column fp.

    Each task compares the fingerprints of a cell bit by bit and gives a forest, not the pairs: a dense
    group of n fingerprints leaves n links at most for each task.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 8192):
                part = fps[at : at + 8192]
                found = cells(part.view(np.uint64), distance, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel()), pa.array(np.repeat(part, found.shape[1]))], names=["cell", "fp"]
                )

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cell = rows.column("cell").to_numpy()
        fps = rows.column("fp").to_numpy().view(np.uint64)
        left, right = [], []
        index, step = np.arange(len(cell) - 1), 1
        while len(index):
            index = index[cell[index] == cell[index + step]]
            near = np.bitwise_count(fps[index] ^ fps[index + step]) <= distance
            left.append(index[near])
            right.append(index[near] + step)
            step += 1
            index = index[index + step < len(cell)]
        if not left or not sum(map(len, left)):
            return
        a, b = forest(fps[np.concatenate(left)].view(np.int64), fps[np.concatenate(right)].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    many = distinct.count()
    parts = parts_for(many * 66, 1_000_000, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = distinct.mapInArrow(spread, "cell long, fp long").repartition(parts, "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(lambda batches: each_group(batches, ["cell"], compare), "a long, b long").distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the least member instead of all links, for each connected part."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, width: int = 2
) -> DataFrame:
    """key, fp (long) and component_id, one row per row of ``docs``.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; ``shingle`` words in a row
    (the whole text if shorter) are hashed. Rows whose fingerprints differ in ``distance`` bits or fewer
    are linked; component_id is the least key reachable. Texts without words (null ones too) have
    fingerprint 0. Equal fingerprints are folded before any comparison, so exact copies cost nothing.
    Other columns of ``docs`` are not read. A null key stays null and never becomes a component_id
    unless all keys of its component are null.
    """
    prints, classes = _classified(docs.select(key, text), key, text, shingle, distance, width)
    return prints.join(classes, "fp").select(key, "fp", "component_id")


def _classified(docs: DataFrame, key: str, text: str, shingle: int, distance: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(all columns but the text with fp, one row per fp with its root and component_id)."""
    prints = stored(fingerprints(docs, text, shingle), "fingerprints")
    folded = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = stored(components(links(folded.select("fp"), distance, width)), "roots")
    rooted = folded.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, stored(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")


def keep_first(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, distance: int = 4, width: int = 2
) -> DataFrame:
    """One row of each group of near-duplicates: that of the least key (null last; of equal keys that of the least hash of its text)."""
    marked = docs.withColumn("__rid", row_key(key, text))
    prints, classes = _classified(marked.select(key, "__rid", text), key, text, shingle, distance, width)
    rank = F.struct(F.col(key).isNull(), F.col(key), F.col("__rid"))
    first = prints.join(classes, "fp").groupBy("root").agg(F.min(rank).alias("first")).select(F.col("first.__rid").alias("__rid"))
    # What goes or is there several times is far less than what stays: the other texts need not be dealt.
    sizes = prints.groupBy("__rid").agg(F.count("*").alias("__n"))
    gone = sizes.join(first, "__rid", "left_anti").select("__rid", F.lit(0).alias("__n"))
    again = sizes.filter("__n > 1").join(first, "__rid", "left_semi").select("__rid", F.lit(2).alias("__n"))
    noted = stored(gone.union(again), "gone")
    rest, others = parted(marked, noted, "__rid")
    joined = others.join(noted, "__rid", "left")
    once = joined.filter("__n is null").drop("__n")
    twice = joined.filter("__n = 2").drop("__n").dropDuplicates(["__rid"])  # the same row several times
    return rest.unionByName(once).unionByName(twice).select(*docs.columns)
