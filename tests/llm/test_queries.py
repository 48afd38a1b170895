"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from check_oracle import compare, connect
from forespell.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_against_duckdb(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None
