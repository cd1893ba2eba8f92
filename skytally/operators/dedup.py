"""Keep-last by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _version(df: DataFrame, order: str) -> Column:
    """The order column and then the row's contents as one number of fixed width, which Spark folds by hash.

    63 bits of the order column above 62 bits of a hash stay under the 38 digits of a decimal.
    """
    above = F.coalesce(F.col(order).cast("decimal(38,0)"), F.lit(-(1 << 63)).cast("decimal(38,0)"))
    contents = F.shiftrightunsigned(F.xxhash64(*df.columns), 2)
    return (above * F.lit(1 << 62).cast("decimal(19,0)") + contents).cast("decimal(38,0)")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` (a column of whole numbers, NULL before all) of each key; column order is kept.

    First the greatest version of each key alone, an aggregate of one number that folds by hash before the shuffle, so copies of
    a key that holds a large share of the rows cost no single task; then the rows that have it, by a semi join Spark can split. No row is
    sorted. Rows of equal ``order`` are settled by a hash of their contents, so the result does not depend on row placement, and
    rows equal in everything become one. A NULL key is a key.
    """
    if not isinstance(order, str):
        (order,) = order
    if not isinstance(df.schema[order].dataType, WHOLE):
        raise TypeError(f"{order} must hold whole numbers")
    marked = df.withColumn("__version", _version(df, order))
    newest = marked.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max("__version").alias("__newest"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]) & (F.col("__version") == F.col("__newest"))
    kept = marked.join(newest.hint("shuffle_hash"), same, "left_semi").drop("__version")
    return kept.distinct()


def merge_latest(history: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of two versions of a table in which ``new`` replaces ``history`` key by key."""
    both = history.withColumn("__order", F.lit(0)).unionByName(new.withColumn("__order", F.lit(1)))
    return latest_by_key(both, keys, "__order").drop("__order")
