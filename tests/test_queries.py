"""Every query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
import check
from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return check.duck(SMALL)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "EAN" in df.columns and df.take(1)


def test_oracles_belong_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, connection, sf, name):
    result = check.compare(spark, connection, sf, name)
    assert not result.startswith("FAIL"), result
