"""The registered queries of this folder that have SQL, against DuckDB."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

from presswork.llm import queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    problem = compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name])
    assert problem is None, problem
