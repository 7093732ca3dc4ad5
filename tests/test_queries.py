"""Every survey query against its SQL, and the entry module."""

import pytest

import __spark_entry__ as entry
from skyspark.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, same_rows, name):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLE_SQL[name])


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_registered_names():
    names = set(entry.queries())
    assert set(QUERIES) <= names
    assert set(entry.oracle_sql()) <= names
