"""Every registered query against its DuckDB query."""

import compare
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare.difference(df, duck, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 3


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
