"""Every registered query gives the rows of its DuckDB SQL."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry

QUERIES = {k: q for family in entry._FAMILIES for k, q in family.queries.items()}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return oracle.connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("key", QUERIES)
def test_same_rows(spark, data, duck, key):
    assert oracle.difference(QUERIES[key](spark, data), duck, SQL[key]) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["week", "week_start", "ctype", "cnt", "rev", "cm", "pft"]
    assert result.count() > 0
