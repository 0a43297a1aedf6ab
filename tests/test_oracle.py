"""Every registered query against DuckDB."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    assert compare(duck, ORACLE[name], QUERIES[name](spark, SF)) == ""


def test_queries_without_sql_have_tests_of_their_own():
    """Only training-data operators, which brute force checks, may lack SQL."""
    without = set(QUERIES) - set(ORACLE)
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 15
    assert frame.columns[:2] == ["uid", "domain_features"]
