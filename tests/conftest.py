from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyspan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def initial_of(spark):
    from tallyspan.schemas import INITIAL_SCHEMA

    def make(rows):
        return spark.createDataFrame(rows, INITIAL_SCHEMA)

    return make


@pytest.fixture
def changes_of(spark):
    from tallyspan.schemas import CHANGES_SCHEMA

    def make(rows):
        return spark.createDataFrame(rows, CHANGES_SCHEMA)

    return make
