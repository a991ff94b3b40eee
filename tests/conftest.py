from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strandline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark, tmp_path):
    """Rows as a parquet-backed frame, so that its size is known."""
    count = iter(range(1000))

    def make(rows, schema):
        path = str(tmp_path / f"frame{next(count)}")
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make
