"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "total_amount"] and df.count() > 0


def test_names_match():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    good, note = compare(spark, entry.queries()[name], entry.oracle_sql()[name], SF_DIR, duck)
    assert good, note
