"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as spark_entry
from presswork.plans.oracle import ORACLES
from presswork.plans.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_core_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    problem = compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert rows and {"split", "source", "label", "n"} == set(rows[0].asDict())


def test_a_wrong_result_is_noticed(spark, duck):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert compare(df, duck, "SELECT 1 AS a, CAST(2 AS DOUBLE) AS b") is None
    assert compare(df, duck, "SELECT 1 AS a, CAST(2.5 AS DOUBLE) AS b") is not None
    assert compare(df, duck, "SELECT 1 AS a, CAST(2 AS DOUBLE) AS c") is not None
