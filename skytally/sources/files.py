"""Folders and small files of any store Spark can write to, through the Hadoop file system of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; an absent folder has none. Nothing below is looked at."""
    system, where = _open(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether any file lies below a folder. The listing ends at the first."""
    system, where = _open(spark, path)
    if not system.exists(where):
        return False
    found = system.listFiles(where, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    system, where = _open(spark, path)
    system.delete(where, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written beside its place, then renamed."""
    system, where = _open(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.part")
    out = system.create(beside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    system.delete(where, False)
    if not system.rename(beside, where):
        raise OSError(f"cannot put {path} in place")


def get_text(spark: SparkSession, path: str) -> str:
    system, where = _open(spark, path)
    source = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
