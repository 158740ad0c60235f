"""Every registered query that has SQL must agree with it; the others must return rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import ORACLES, QUERIES
from catalog.check import compare

SF_DIR = "/root/testdata/sf0.001"
CHECKED = sorted(oracle_sql())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    assert compare(spark, name, queries()[name], oracle_sql()[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry_gives_one_score_row(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["rows"] > 0
