"""Approximate nearest neighbours by inner product: p-stable hash tables, several buckets of each probed."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import each_group, parts_for, stored

TABLES, HASHES, WIDTH, PROBES = 5, 8, 2.5, 96
SEED = 5
HOT = 4096  # rows of a bucket that stay together; more are dealt to several tasks, and its probes go to each
HELD = 2_000_000  # results a task holds before it prunes them
ROUGH = 1e-9  # by so much of the greatest score the faster arithmetic of the first sorting may be off


class Tables:
    """Hash functions for vectors of one dimension whose norms are at most ``norm``.

    A vector gets one more component that brings its norm to ``norm``, a query gets 0 there: then the nearest by
    Euclidean distance is the one with the largest inner product.
    """

    def __init__(self, dimension: int, norm: float, tables: int, hashes: int, width: float):
        rng = np.random.default_rng(SEED)
        self.norm, self.tables, self.hashes = norm, tables, hashes
        self.lines = rng.normal(size=(dimension + 1, tables * hashes)) / width
        self.shifts = rng.uniform(0, 1, tables * hashes)
        self.factors = rng.integers(1, 1 << 62, hashes) * 2 + 1

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Positions on the lines in cells, by table."""
        unit = vectors / self.norm
        rest = np.zeros(len(unit)) if query else np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
        found = np.column_stack([unit, rest]) @ self.lines + self.shifts
        return found.reshape(len(unit), self.tables, self.hashes)

    def buckets(self, cells: np.ndarray, table: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = ((cells.astype(np.int64) + 7919) * self.factors).sum(axis=-1) + (table + 1) * 0x5851F42D4C957F2D
            return value ^ (value >> 31)


def probe_order(inside: np.ndarray, probes: int) -> list[tuple[int, ...]]:
    """Sets of steps to neighbouring cells, most likely first; step i < k is one cell down on line i, else one up on line i - k.

    ``inside`` is the place within the cell, 0 to 1, on each line. The likelihood of a set falls with the sum of its squared
    distances to the cell borders. Sets grow from the sorted steps by shifting or extending the last one, through a heap.
    """
    k = len(inside)
    costs = np.concatenate([inside, 1 - inside]) ** 2
    order = np.argsort(costs, kind="stable").tolist()
    cost = costs[order].tolist()
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        lines = [order[i] % k for i in chosen]
        if len(set(lines)) == len(lines):
            out.append(tuple(order[i] for i in chosen))
        last = chosen[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


ROWS = "bucket long, probe boolean, vec_class long, vector binary, ids array<long>"
NAMES = ["bucket", "probe", "vec_class", "vector", "ids"]


def _rows(tables: Tables, probes: int):
    """Index rows of every class in each table, and the probes of those that hold queries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(tables.tables)
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            at = tables.places(vectors, query=False)
            found = tables.buckets(np.floor(at), every[None, :])
            row = np.repeat(np.arange(len(vectors)), tables.tables)
            yield _batch(batch, row, found.ravel(), False)
            asking = np.flatnonzero(batch.column("asks").to_numpy(zero_copy_only=False))
            at = tables.places(vectors[asking], query=True) if len(asking) else at[:0]
            for i, places in zip(asking.tolist(), at):
                cells, steps = np.floor(places), []
                for t in range(tables.tables):
                    sets = probe_order(places[t] - cells[t], probes)
                    moved = np.repeat(cells[t][None, :], len(sets), axis=0)
                    for s, chosen in enumerate(sets):
                        for step in chosen:
                            moved[s, step % tables.hashes] += 1 if step >= tables.hashes else -1
                    steps.append(tables.buckets(moved, np.full(len(sets), t)))
                found = np.unique(np.concatenate(steps))
                yield _batch(batch, np.full(len(found), i), found, True)

    return work


def _batch(batch: pa.RecordBatch, row: np.ndarray, bucket: np.ndarray, probe: bool) -> pa.RecordBatch:
    take = pa.array(row, pa.int64())
    ids = pa.nulls(len(row), pa.list_(pa.int64())) if probe else batch.column("ids").take(take)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array([probe] * len(row)), batch.column("vec_class").take(take), batch.column("vector").take(take), ids],
        names=NAMES,
    )


def _best(asker: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int):
    """The first ``most`` different ids of each asker, by score and then by id."""
    order = np.lexsort((ids, -score, asker))
    asker, ids, score = asker[order], ids[order], score[order]
    again = np.zeros(len(ids), bool)  # an id found in several tables has one score
    again[1:] = (asker[1:] == asker[:-1]) & (ids[1:] == ids[:-1])
    asker, ids, score = asker[~again], ids[~again], score[~again]
    begin = np.concatenate([[True], asker[1:] != asker[:-1]]) if len(asker) else np.zeros(0, bool)
    rank = np.arange(len(asker)) - np.maximum.accumulate(np.where(begin, np.arange(len(asker)), 0)) if len(asker) else begin
    keep = rank < most
    return asker[keep], ids[keep], score[keep]


def _search(most: int):
    def bucket(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        probe = rows.column("probe").to_numpy(zero_copy_only=False).astype(bool)
        if probe.all() or not probe.any():
            return None
        vectors = _matrix(rows.column("vector").combine_chunks())
        classes = rows.column("vec_class").to_numpy()
        own = [np.array(x, np.int64) for x, p in zip(rows.column("ids").to_pylist(), probe) if not p]
        sizes = np.array([len(x) for x in own])
        index, askers = vectors[~probe], np.flatnonzero(probe)
        out = []
        for at in range(0, len(askers), 256):
            some = askers[at : at + 256]
            rough = vectors[some] @ index.T
            n = min(most, len(index))
            least = -np.partition(-rough, n - 1, axis=1)[:, n - 1 : n]
            # Every row that reaches the last place is scored exactly, as ties are settled by id.
            close = ROUGH * np.maximum(np.abs(rough).max(axis=1, keepdims=True), np.abs(least))
            floor = least - close
            asker, place = np.nonzero(~(rough < np.where(np.isfinite(floor), floor, -np.inf)))
            for a in range(0, len(asker), 1 << 15):
                q, p = asker[a : a + (1 << 15)], place[a : a + (1 << 15)]
                scores = np.einsum("nd,nd->n", vectors[some[q]], index[p])
                flat = np.concatenate([own[k] for k in p.tolist()])
                many = sizes[p]
                out.append(_best(np.repeat(classes[some[q]], many), flat, np.repeat(scores, many), most))
        return _best(*map(np.concatenate, zip(*out)), most)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def groups(rows: pa.Table) -> Iterator[tuple]:
            key = np.stack([rows.column("bucket").to_numpy(), rows.column("sub").to_numpy()])
            cut = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [key.shape[1]]])
            for a, b in zip(cut[:-1], cut[1:]):
                if (found := bucket(rows.slice(a, b - a))) is not None:
                    yield found

        for found in each_group(batches, ["bucket", "sub"], groups):
            held.append(found)
            size += len(found[0])
            if size > HELD:
                held = [_best(*map(np.concatenate, zip(*held)), most)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield _results(*held[0])
                    held, size = [], 0
        if held:
            yield _results(*_best(*map(np.concatenate, zip(*held)), most))

    return work


def _results(asker, ids, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(asker), pa.array(ids), pa.array(score)], names=["vec_class", "vec_id", "score"])


def nearest(
    embeddings: DataFrame,
    is_query,
    count: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, vec_id and score: up to ``count`` rows of largest inner product for each row that ``is_query`` (a Column) picks.

    Candidates are the rows that share a probed bucket of some table; they are ranked by the inner product of the given vectors in
    double precision, ties by smaller id, the row itself left out. A query whose buckets hold fewer than ``count`` others is compared with
    all rows, block by block. Equal vectors are one class, which holds the ``count`` + 1
    least of its ids: no query can need more of them, so a vector that a third of all rows share costs as much as one row.
    A null key, and a vector that is null, zero, or holds null or non-finite components, take no part; neither do vectors of another
    than the commonest dimension. Repeated rows are one row. Other columns are not read.
    """
    most = count + 1
    spark = embeddings.sparkSession
    x = F.col("v")
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists("v", lambda c: c != 0))
    rows = rows.withColumn("asks", F.coalesce("asks", F.lit(False)))
    most_of = F.array_max(F.transform("v", F.abs))  # taken out of the squares, which could pass the greatest double
    norm = most_of * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + (c / most_of) * (c / most_of)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("norm")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    rows = rows.filter(F.size("v") == sizes["d"]).withColumn("v", F.transform("v", lambda c: c + F.lit(0.0)))  # -0.0 is 0.0
    rows = rows.distinct()
    # The least ids of each vector: a limit per group, which Spark applies before the shuffle.
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= most)
    classes = ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("vec_class", F.element_at("ids", 1))
    asking = rows.filter("asks").select("v", F.col("vec_id").alias("query_id"))
    members = stored(asking.join(classes.select("v", "vec_class"), "v").select("vec_class", "query_id"), "members")
    asked = members.select("vec_class", F.lit(True).alias("asks")).distinct()
    classes = stored(classes.join(asked, "vec_class", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "classes")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.array(v, "<f8").tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_class"), pa.array(data, pa.binary()), batch.column("ids"), batch.column("asks")],
                names=["vec_class", "vector", "ids", "asks"],
            )

    lean = classes.mapInArrow(packed, "vec_class long, vector binary, ids array<long>, asks boolean")
    hashed = stored(lean.mapInArrow(_rows(Tables(sizes["d"], sizes["norm"], tables, hashes, width), probes), ROWS), "buckets")
    hot = hashed.filter("not probe").groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    hot = hot.select("bucket", F.ceil(F.col("n") / HOT).cast("int").alias("subs"))
    joined = hashed.join(hot, "bucket", "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
    one = F.array(F.pmod(F.xxhash64("vec_class"), F.col("subs")).cast("int"))
    subs = F.when(F.col("probe"), F.sequence(F.lit(0), F.col("subs") - 1)).otherwise(one)
    dealt = joined.select(*NAMES, F.explode(subs).alias("sub"))
    parts = parts_for(sizes["n"] * tables, 20_000, spark.sparkContext.defaultParallelism)
    dealt = dealt.repartition(parts, "bucket", "sub").sortWithinPartitions("bucket", "sub")
    result = "vec_class long, vec_id long, score double"
    found = stored(dealt.mapInArrow(_search(most), result).dropDuplicates(["vec_class", "vec_id"]), "found")
    # Too little found: every block of rows is a bucket, and these queries probe them all.
    total = min(most, sizes["n"])
    reached = found.groupBy("vec_class").agg(F.count("*").alias("n")).filter(F.col("n") >= total)
    short = stored(asked.join(reached, "vec_class", "left_anti").select("vec_class"), "short")
    if not short.isEmpty():
        blocks = parts_for(sizes["n"], HOT)
        spread = lean.select(F.pmod(F.xxhash64("vec_class"), F.lit(blocks)).alias("bucket"), F.lit(False).alias("probe"), "vec_class", "vector", "ids")
        probing = lean.join(short, "vec_class").select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("bucket"), F.lit(True).alias("probe"), "vec_class", "vector",
            F.lit(None).cast("array<long>").alias("ids"),
        )
        dealt = spread.union(probing).withColumn("sub", F.lit(0))
        dealt = dealt.repartition(parts_for(blocks, 4), "bucket").sortWithinPartitions("bucket", "sub")
        found = found.join(short, "vec_class", "left_anti").union(dealt.mapInArrow(_search(most), result))
    by_class = Window.partitionBy("vec_class").orderBy(F.desc("score"), "vec_id")
    best = found.dropDuplicates(["vec_class", "vec_id"]).withColumn("r", F.row_number().over(by_class)).filter(F.col("r") <= most)
    lists = best.groupBy("vec_class").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("list"))
    own = members.join(lists, "vec_class")
    others = F.slice(F.filter("list", lambda e: e["vec_id"] != F.col("query_id")), 1, count)
    each = own.select("query_id", F.posexplode(others).alias("p", "e"))
    return each.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))
