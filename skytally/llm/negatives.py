"""Hard negatives by vertical scans: blocks of vectors are read column by column, in the order of the anchor's magnitudes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import parts_for, stored

BLOCK_BYTES = 16 << 20  # of vectors that a task holds as one block of columns
BLOCK_ROWS = 32_768
GROUP_BYTES = 8 << 20  # of anchors that meet a block at a time
STEP = 8  # columns read between two looks at the bounds
EXACT = float(1 << 53)  # whole numbers up to here are exact in double precision
LONG = (1 << 63) - 1


def _once(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The places of the rows, one of those that are given several times."""
    _, number, times = np.unique(ids, return_inverse=True, return_counts=True)
    own = times[number] == 1
    seen = set()
    for i in np.flatnonzero(~own).tolist():
        row = (int(ids[i]), int(labels[i]), matrix[i].tobytes())
        own[i] = row not in seen
        seen.add(row)
    return np.flatnonzero(own)


class Block:
    """Whole-number vectors of one length, by column, with the least and greatest value of each column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        own = _once(ids, labels, matrix)
        self.ids, self.labels = ids[own], labels[own]
        self.columns = np.ascontiguousarray(matrix[own].T)
        self.least, self.most = (f(initial=0.0, axis=1) if not len(self.ids) else f(axis=1) for f in (self.columns.min, self.columns.max))
        self.reach = float(np.abs(self.columns).max(initial=0.0))

    def plan(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(columns by falling magnitude of the anchor; least and most that those from the i-th on can add)."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.most])[:, order]
        left = np.zeros((2, len(anchor) + 1))
        left[0, :-1] = np.cumsum(ends.min(axis=0)[::-1])[::-1]
        left[1, :-1] = np.cumsum(ends.max(axis=0)[::-1])[::-1]
        return order, left[0], left[1]

    def scan(self, anchor: np.ndarray, rows: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of those that ``shrink(lower, upper)`` keeps until all columns are read.

        ``shrink`` gets bounds of the scores of the rows still there and returns which stay.
        """
        if self.reach * float(np.abs(anchor).max(initial=0.0)) * max(len(anchor), 1) >= EXACT:
            whole = [int(x) for x in anchor.tolist()]
            scores = [sum(a * int(b) for a, b in zip(whole, self.columns[:, r].tolist())) for r in rows.tolist()]
            kept = shrink(*(np.array(scores, object),) * 2).astype(bool)
            return rows[kept], np.array(scores, object)[kept]
        order, low, high = self.plan(anchor)
        score, whole_block = np.zeros(len(rows)), len(rows) == len(self.ids)
        for at in range(0, len(order), STEP):
            some = order[at : at + STEP]
            for d in some.tolist():
                column = self.columns[d] if whole_block else self.columns[d][rows]
                score += anchor[d] * column
            end = at + len(some)
            kept = shrink(score + low[end], score + high[end])
            if not kept.all():
                rows, score, whole_block = rows[kept], score[kept], False
                if not len(rows):
                    break
        if not len(order):
            kept = shrink(score, score)
            rows, score = rows[kept], score[kept]
        return rows, score


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value, or None if there are fewer."""
    if len(values) < k:
        return None
    return sorted(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def _first(block: Block, rows: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``count`` rows of greatest score, ties by smaller id."""
    if len(rows) > count:
        near = scores >= _kth(scores, count)
        rows, scores = rows[near], scores[near]
    ids = block.ids[rows]
    order = sorted(range(len(ids)), key=lambda i: (-int(scores[i]), int(ids[i])))[:count]
    return ids[order], scores[order]


def positives(block: Block, anchor_id: int, label: int, anchor: np.ndarray, count: int):
    """The ``count`` other rows of the anchor's label with the greatest scores."""

    def shrink(lower, upper):
        least = _kth(lower, count)
        return np.ones(len(lower), bool) if least is None else upper >= least

    rows = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
    return _first(block, *block.scan(anchor, rows, shrink), count)


def negatives(block: Block, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], count: int):
    """For each window of scores the ``count`` rows of another label with the greatest scores in it."""

    def shrink(lower, upper):
        useful = np.zeros(len(lower), bool)
        for low, high in windows:
            inside = (upper >= low) & (lower <= high)
            sure = _kth(lower[(lower >= low) & (upper <= high)], count)
            useful |= inside if sure is None else inside & (upper >= sure)
        return useful

    rows, scores = block.scan(anchor, np.flatnonzero(block.labels != label), shrink)
    out = []
    for low, high in windows:
        within = (scores >= low) & (scores <= high)
        out.append(_first(block, rows[within], scores[within], count))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    return data.reshape(len(column), len(data) // max(len(column), 1))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays as bytes, next to their length."""
    for batch in batches:
        vectors = batch.column("v")
        sizes = vectors.value_lengths().to_numpy()
        flat = vectors.flatten().to_numpy().astype("<f8").tobytes()
        ends = (8 * np.concatenate([[0], np.cumsum(sizes)])).tolist()
        data = pa.array([flat[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
        columns = [batch.column("vec_id"), batch.column("label"), data, pa.array(sizes, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "d"])


def _block(rows: pa.Table) -> Block:
    return Block(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("vector")))


def _as_long(values: list) -> pa.Array:
    return pa.array([max(-LONG, min(LONG, int(v))) for v in values], pa.int64())


def _find_positives(count: int):
    names = ["anchor_id", "anchor", "vec_id", "score"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.int64()])))

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        block, out = _block(rows), [[], [], [], []]
        columns = (anchors.column(c).to_pylist() for c in ("vec_id", "anchor", "label"))
        for key, number, label, vector in zip(*columns, _matrix(anchors.column("vector"))):
            ids, scores = positives(block, key, label, vector, count)
            for column, values in zip(out, ([key] * len(ids), [number] * len(ids), ids.tolist(), scores.tolist())):
                column += values
        return pa.Table.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), _as_long(out[3])], schema=schema)

    return work


def _find_negatives(count: int, low: int, high: int):
    names = ["anchor_id", "anchor", "positive_id", "positive_score", "negative_id", "negative_score"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        block, out = _block(rows), [[] for _ in names]
        columns = (anchors.column(c).to_pylist() for c in ("vec_id", "anchor", "label", "positives"))
        for key, number, label, pairs, vector in zip(*columns, _matrix(anchors.column("vector"))):
            # Whole bounds of low * positive <= 100 * negative <= high * positive.
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in pairs]
            for p, (ids, scores) in zip(pairs, negatives(block, label, vector, windows, count)):
                n = len(ids)
                found = ([key] * n, [number] * n, [p["vec_id"]] * n, [p["score"]] * n, ids.tolist(), scores.tolist())
                for column, values in zip(out, found):
                    column += values
        return pa.Table.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), _as_long(out[5])], schema=schema)

    return work


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, work, schema: str) -> DataFrame:
    """``work`` on each block of rows with each group of anchors of the same dimension."""
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("group", every_group)
    right = anchors.withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int")).withColumn("part", every_block)
    keys = ["d", "group", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (rank int, the others long).

    A component x counts as floor(scale * x); a score is the whole inner product with the anchor, higher first, ties by smaller
    id. For each anchor that ``is_anchor`` (a Column) picks and each of its first ``n_positives`` other rows of the same label, the first
    ``n_negatives`` rows of another label with low * positive <= 100 * negative <= high * positive.

    Every block of rows meets every group of anchors, both of bounded size. In a block the columns are read in the anchor's falling
    order of magnitude; what the rest of the columns can still add, by their least and greatest values, bounds each row's score, and rows
    that no bound lets into the result leave the candidates. Blocks are dealt by id, so a label, or a vector, that a third of the
    rows have is spread evenly, and rows of equal score are settled by id.

    A null key or label, and a vector that is null or has null or non-finite components, take no part. Vectors meet those of the same
    length only. A row given twice is one row; if one id has several vectors or labels, each is a row, and each an anchor. A score beyond
    53 bits is computed in whole numbers of any size and given as the nearest 64-bit number. Other columns are not read; an empty
    table, or one without anchors, gives no rows.
    """
    rows = embeddings.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    # A floor of a double is a long in SQL; greater components are whole numbers as they are.
    def whole(c):
        most = F.lit(sys.float_info.max)
        return F.when(F.abs(c * scale) < 2.0**62, F.floor(c * scale).cast("double")).otherwise(F.greatest(F.least(c * scale, most), -most))

    rows = rows.withColumn("v", F.transform("v", whole))
    packed = "vec_id long, label long, vector binary, d int"
    anchors = rows.filter("asks").select("vec_id", "label", "v").mapInArrow(_packed, packed)
    anchors = anchors.distinct().withColumn("anchor", F.monotonically_increasing_id())
    anchors = stored(anchors, "anchors")
    rows = stored(rows.select("vec_id", "label", "v").mapInArrow(_packed, packed), "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.max("d").alias("d")).first()
    n, width = sizes["n"], 8 * max(sizes["d"] or 0, 1)
    parallelism = rows.sparkSession.sparkContext.defaultParallelism
    blocks = parts_for(n, max(1, min(BLOCK_ROWS, BLOCK_BYTES // width)), 2 * parallelism)
    groups = parts_for(anchors.count(), max(1, GROUP_BYTES // width))

    found = _meet(rows, anchors, blocks, groups, _find_positives(n_positives), "anchor_id long, anchor long, vec_id long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= n_positives)
    lists = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("positives"))
    asking = stored(anchors.join(lists, "anchor"), "asking")

    schema = "anchor_id long, anchor long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(rows, asking, blocks, groups, _find_negatives(n_negatives, low, high), schema)
    best = Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n_negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
QUALIFY rank <= 10
"""
