"""Every registered query against its SQL in DuckDB, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
import check
from daystrata.catalog.queries import all_queries

ROWS_ONLY = {"predictions"}


@pytest.fixture(scope="module")
def db(sf_dir):
    return check.database(sf_dir)


def test_every_query_has_sql():
    assert set(all_queries()) - set(registered.oracle_sql()) == ROWS_ONLY
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, db, sf_dir, name):
    same, rows, note = check.compare(spark, db, sf_dir, name)
    assert same, note
    assert rows > 0


def test_entry(spark):
    assert registered.entry(spark).count() == 2281


@pytest.mark.parametrize("name", ["label_index", "category_index", "feature_vector", "silver_split", "merge_outer", "merge_outer_split"])
def test_a_frame_read_again_is_not_made_again(spark, sf_dir, name):
    """What several passes read is stored once, so the result no longer reads the line items."""
    files = all_queries()[name](spark, sf_dir).inputFiles()
    assert files and not any("lineitem" in f for f in files)
