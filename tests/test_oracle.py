import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tarmaq import oracle
from tarmaq.compare import difference
from tarmaq.plans.catalogue import QUERIES
from tests.conftest import DATA


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_flight_query_has_an_oracle():
    assert set(QUERIES) == set(oracle.QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, database, name):
    found = contract.queries()[name](spark, DATA).toArrow()
    wanted = database.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert difference(found, wanted) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 24


def test_no_forbidden_constructs():
    code = "\n".join(p.read_text() for p in Path(contract.__file__).parent.glob("tarmaq/**/*.py"))
    assert not re.search(r"\b(udf|pandas_udf|crossJoin|localCheckpoint|toPandas)\b", code)
