"""Keyed tables that are rewritten part by part: an upsert touches the parts its rows belong to and no other.

``data/<part>=P/v=N`` holds part P as batch N left it, ``versions/N.json`` says which version of each part is current after batch N.
A batch writes its parts in a staging folder which Spark swaps in as a whole, then its version file. A reader takes the newest
version file, so it sees a batch as a whole or not at all; the versions before the last batch stay until the next, so a reader that has just
begun loses nothing. Writing batch N again starts from the versions before N and gives the same table. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.operators.dedup import latest_by_key
from skytally.schemas import with_columns
from skytally.sources import files

Versions = dict[str, int]


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        part: Callable[[], Column],
        part_name: str = "dt",
        cluster: Sequence[str] = (),
        order: str | None = None,
    ):
        """``part`` gives the part of a row as text and must follow from the keys; within a part rows lie sorted by
        ``cluster``, so that a filter on these columns skips what it does not need. Of two rows with one key the one with the greater
        ``order`` column stays, or without that the later one."""
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.part, self.part_name, self.cluster, self.order = part, part_name, list(cluster), order

    def snapshot(self, before: int | None = None) -> tuple[int, Versions]:
        """(number of the newest batch, below ``before`` if given; version of each part then)."""
        numbers = [int(name[:-5]) for name in files.names(self.spark, f"{self.path}/versions") if name.endswith(".json") and name[0] != "."]
        known = [n for n in numbers if before is None or n < before]
        if not known:
            return -1, {}
        return max(known), json.loads(files.get_text(self.spark, f"{self.path}/versions/{max(known)}.json"))

    def parts(self) -> list[str]:
        return sorted(self.snapshot()[1])

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Current rows, of the parts from ``first`` to ``last`` only if given. Folders of other parts are not listed."""
        versions = self.snapshot()[1]
        return self._rows({p: v for p, v in versions.items() if (first is None or p >= first) and (last is None or p <= last)})

    def _rows(self, versions: Versions) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        stored = with_columns(self.schema, f"{self.part_name} STRING, v BIGINT")
        data = f"{self.path}/data"
        paths = [f"{data}/{self.part_name}={p}/v={v}" for p, v in sorted(versions.items())]
        return self.spark.read.schema(stored).option("basePath", data).parquet(*paths).select(*self.schema.fieldNames())

    def merge(self, rows: DataFrame, batch_id: int, parts: dict[str, int] | None = None) -> dict[str, int]:
        """Upsert ``rows``, which hold each key once, as batch ``batch_id``; the parts it rewrote, with the number of rows each was
        given. ``parts`` are these if known."""
        rows = rows.select(*self.schema.fieldNames()).persist()  # the batch: read for its parts, and for the merge
        try:
            touched = self._parts_of(rows) if parts is None else parts
            if touched:
                base = self.snapshot(before=batch_id)[1]
                old = self._rows({p: v for p, v in base.items() if p in touched})
                if self.order:
                    merged = latest_by_key(old.union(rows), self.keys, self.order)
                else:
                    # The batch is the small side and goes to where the stored rows are, as far as Spark finds it small enough.
                    fresh = rows.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
                    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys])
                    merged = old.join(fresh, same, "left_anti").union(rows)
                self._write(merged, touched, touched, batch_id)
        finally:
            rows.unpersist()
        return touched

    def replace(self, rows: DataFrame, touched: Iterable[str], batch_id: int) -> None:
        """Let ``rows`` be all that the ``touched`` parts hold."""
        rows = rows.select(*self.schema.fieldNames()).persist()
        try:
            self._write(rows, touched, self._parts_of(rows), batch_id)
        finally:
            rows.unpersist()

    def forget(self, parts: Iterable[str], batch_id: int) -> None:
        """Take parts out of the table, after the merge of the same batch if there is one. Their files go at once."""
        number, versions = self.snapshot(before=batch_id + 1)
        gone = set(parts) & set(versions)
        if gone:
            left = {p: v for p, v in versions.items() if p not in gone}
            self._commit(left, left, gone, min(number, batch_id - 1), batch_id)

    def _parts_of(self, rows: DataFrame) -> dict[str, int]:
        found = rows.groupBy(self.part().alias("part")).agg(F.count("*").alias("n")).collect()  # one row a part
        return {r["part"]: r["n"] for r in found}

    def _write(self, rows: DataFrame, touched: Iterable[str], filled: Iterable[str], batch_id: int) -> None:
        number, base = self.snapshot(before=batch_id)
        if filled:
            # Parts are dealt to tasks by measured size: a great one to several, small ones together.
            dealt = rows.withColumn(self.part_name, self.part()).withColumn("v", F.lit(batch_id)).hint("rebalance", self.part_name)
            dealt.sortWithinPartitions(self.part_name, *self.cluster).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(self.part_name, "v").parquet(f"{self.path}/data")
        after = {p: v for p, v in base.items() if p not in touched} | dict.fromkeys(filled, batch_id)
        self._commit(after, base, touched, number, batch_id)

    def _commit(self, after: Versions, base: Versions, touched, before: int, batch_id: int) -> None:
        files.put_text(self.spark, f"{self.path}/versions/{batch_id}.json", json.dumps(after))
        for part in touched:
            folder = f"{self.path}/data/{self.part_name}={part}"
            left = {f"v={v}" for v in (after.get(part), base.get(part)) if v is not None}
            for name in files.names(self.spark, folder):
                if name not in left:
                    files.remove(self.spark, f"{folder}/{name}")
            if not left:
                files.remove(self.spark, folder)
        for name in files.names(self.spark, f"{self.path}/versions"):
            if name.endswith(".json") and name[0] != "." and int(name[:-5]) < min(before, batch_id):
                files.remove(self.spark, f"{self.path}/versions/{name}")
