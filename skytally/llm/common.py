"""What the operators share: tables, stored intermediates, texts as bytes, sorted groups in tasks."""

from __future__ import annotations

import ctypes
import gc
import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import work_path

# The six bytes that end a word; words are `[^\x20\x09-\x0D]+`, as bytes.split() gives them.
SPACES = " \t\n\x0b\x0c\r"


# Whole texts are long: Spark's 10,000 rows a batch would hold more memory, twice for each task, than the work itself.
ROWS_A_BATCH = 500


MARK_BITS = 27  # binary digits of the number of bits that ``parted`` sends at most: 16 MB


def short_batches(spark: SparkSession) -> SparkSession:
    """Fewer rows in each Arrow batch, unless the session has a number of its own."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(ROWS_A_BATCH))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps do not compute them again,
    and lost executors lose nothing of them."""
    path = work_path(df.sparkSession, f"llm-{label}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_buckets(df: DataFrame, label: str, buckets: int, key: str) -> DataFrame:
    """``stored`` as a bucketed table: a join by ``key`` does not move its rows. Rows that are dealt by ``key`` already, into as many partitions, give
    one file a bucket. The catalog keeps no trace of the table."""
    spark, path = df.sparkSession, work_path(df.sparkSession, f"llm-{label}")
    name = f"skytally_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def parted(rows: DataFrame, some: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose 64-bit ``key`` is surely not in the stored table ``some``, the others), so that only the others need to be joined with it.

    Every key of ``some`` sets one of sixteen bits for each; the bits are sent to all tasks, ``MARK_BITS`` of them at most (beyond that more rows are
    among the others, and the result of a join with them is the same)."""
    bits = 1 << min(MARK_BITS, max(15, (16 * some.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    block, bit = F.shiftright(place, 15).cast("int"), place.bitwiseAND(32767)
    marks = some.select(block.alias("__block"), bit.alias("__bit")).groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__marks"))
    looked = rows.withColumns({"__block": block, "__bit": bit}).join(F.broadcast(marks), "__block", "left")
    byte = "cast(conv(hex(substring(__marks, cast(__bit div 8 as int) + 1, 1)), 16, 10) as int)"
    marked = F.coalesce(F.expr(f"shiftright({byte}, cast(__bit % 8 as int)) & 1"), F.lit(0))
    looked = looked.withColumn("__marked", marked).drop("__block", "__bit", "__marks")
    return looked.filter("__marked = 0").drop("__marked"), looked.filter("__marked = 1").drop("__marked")


def parts_for(rows: float, per_part: int, least: int = 1) -> int:
    """Number of partitions that holds ``per_part`` rows in each."""
    return max(least, math.ceil(rows / per_part))


def row_key(*columns: str):
    """A key of a row's contents. Equal rows share it, which no operator here minds."""
    return F.xxhash64(*columns)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes, offsets) of a string column; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``most_bytes`` of text (a longer text stands alone)."""
    _, at = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + most_bytes, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def each_group(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Calls ``work`` with whole groups of rows that come sorted by ``keys``: many groups at a time,
    never part of one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cut = _last_start(batch, keys)
        if cut == 0 and held and _same(held[-1], batch, keys):
            held.append(batch)
            continue
        if held and not _same(held[-1], batch, keys):
            yield from work(pa.Table.from_batches(held))
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            yield from work(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from work(pa.Table.from_batches(held))


def _same(before: pa.RecordBatch, after: pa.RecordBatch, keys: list[str]) -> bool:
    return all(before.column(k)[before.num_rows - 1].as_py() == after.column(k)[0].as_py() for k in keys)


def _last_start(batch: pa.RecordBatch, keys: list[str]) -> int:
    """The row where the last group of the batch begins."""
    changed = np.zeros(batch.num_rows, bool)
    for k in keys:
        values = batch.column(k).fill_null(0).to_numpy(zero_copy_only=False)
        changed[1:] |= values[1:] != values[:-1]
    where = np.flatnonzero(changed)
    return int(where[-1]) if len(where) else 0


def per_worker(name: str, make: Callable[[], object]):
    """An object that each Python worker makes once and keeps from task to task.

    Functions travel with the job by value, so what they remember would start anew in every task."""
    kept = sys.modules.setdefault("_skytally_worker", types.ModuleType("_skytally_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def release_worker() -> None:
    """Drop what tasks of other operators keep in this Python worker; they would make it again. What that frees goes back to the machine,
    where the executor's heap needs it."""
    sys.modules.pop("_skytally_worker", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than that of Linux
        return


def pack(values: np.ndarray) -> bytes:
    """64-bit integers in few bytes where neighbours are alike: differences, byte by byte, compressed."""
    steps = values.astype("<i8")
    steps[1:] -= values[:-1].astype("<i8")
    planes = np.empty((8, len(steps)), np.uint8)
    for k, byte in enumerate(steps.view(np.uint8).reshape(-1, 8).T):  # plane by plane is much quicker than all at once
        planes[k] = byte
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, np.int64)
    planes = pa.decompress(data[8:], 8 * size, codec="zstd", asbytes=True)
    steps = np.empty((size, 8), np.uint8)
    for k, byte in enumerate(np.frombuffer(planes, np.uint8).reshape(8, -1)):
        steps[:, k] = byte
    return np.cumsum(steps.view("<i8").ravel())


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of equal values."""
    if len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return starts, np.concatenate([starts[1:], [len(values)]])
