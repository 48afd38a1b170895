"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from check_oracle import compare, connect
from registry import duckdb_sql, spark_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(spark_queries.all_queries()) == set(duckdb_sql.all_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(duckdb_sql.all_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


@pytest.mark.parametrize(
    "name",
    [
        "complete_batch_per_k",
        "complete_batch_ci",
        "complete_batch_unmatched",
        "complete_batch_scan_ties",
        "match_counts_ci",
        "match_entries",
        "next_char_facets_batch",
        "prefix_ranges",
        "word_start_matches",
    ],
)
def test_query_without_broadcast(spark, con, shuffled, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["qid", "rank", "text", "weight"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["complete_stream", "complete_stream_long", "complete_stream_stored"])
def test_streams_of_tables_in_folders(spark, tmp_path, name):
    """A table may be a folder of files."""
    for table in ("documents", "conversations", "events"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(300).repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert compare(spark, connect(str(tmp_path)), name, str(tmp_path)) is None
