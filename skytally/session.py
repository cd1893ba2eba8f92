"""Session settings the library depends on, and where it may write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Cluster-minded defaults. AQE sizes shuffle partitions down from the initial number,
# splits skewed join partitions, and broadcasts a side only after it has seen its size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "skytally", master: str | None = None, **conf: object) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, str(value))
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; a caller's session may carry another time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh directory in the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="skytally-")
    return f"{base.rstrip('/')}/skytally/{label}-{uuid.uuid4().hex}"
