"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import oracle
from tests.compare import differences

QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()
CORE = oracle.statements()


def test_every_statement_has_a_query():
    """Queries of the optional part may do without SQL; their own tests see to them."""
    assert set(STATEMENTS) <= set(QUERIES)
    assert {name for name in QUERIES if name in entry._all_queries()} == set(CORE)


@pytest.mark.parametrize("name", list(CORE))
def test_matches_sql(spark, small_dir, small_db, name):
    assert differences(QUERIES[name](spark, small_dir), small_db, STATEMENTS[name]) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["season", "final_championship_position"]
    assert result.count() == 70
