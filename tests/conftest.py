from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from skytally.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "skytally-tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """(region, counts) pairs to a traffic table with buckets every five minutes."""

    def build(*pairs, start=1767225600):
        rows = [(region, start + 300 * i, n) for region, counts in pairs for i, n in enumerate(counts)]
        table = spark.createDataFrame(rows, "region STRING, at BIGINT, aircraft_count BIGINT")
        return table.selectExpr("region", "timestamp_seconds(at) AS bucket_sk", "aircraft_count")

    return build


def rows_of(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
