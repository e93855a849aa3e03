"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from statloom import workload
from tests.oracle import compare

QUERIES, ORACLE = workload.QUERIES, workload.ORACLE


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, small_dir, name):
    problem = compare(spark, duck, name, QUERIES[name], ORACLE.get(name), small_dir)
    assert problem is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_the_entry_has_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_returns_the_flagship_profile(spark):
    df = entry.entry(spark)
    assert df.columns == ["tipo", "mes", "pct"]
    assert df.count() > 0
