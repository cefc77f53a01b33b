"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_rows(spark):
    result = entry(spark)
    assert {"pmid", "class_value", "abstract"} <= set(result.columns)
    assert result.count() > 0
