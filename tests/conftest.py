from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tarmaq.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="10000",
        spark__checkpoint__dir=str(folder / "shared"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flights(spark):
    from tarmaq.plans.fixtures import Flights

    return Flights(spark, DATA)


def rows(df):
    """The rows of a small result as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
