"""Every registered query against its DuckDB SQL, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests.compare import differences, duckdb_views
from workload.oracles import ORACLES
from workload.queries import all_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_views(sf_dir)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(ORACLES)
    assert set(all_queries()) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_duckdb(spark, con, sf_dir, name):
    result = all_queries()[name](spark, sf_dir)
    assert differences(result, con, ORACLES[name]) == []


def test_entry_is_the_flagship(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["order_year", "p_type", "revenue"]
    assert result.count() >= 7
