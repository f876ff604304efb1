"""Queries beside their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from tests.compare import differences
from trackside.llm import queries, sql


@pytest.mark.parametrize("name", sorted(sql.statements()))
def test_query_matches_sql(spark, small_dir, small_db, name):
    assert differences(queries.queries()[name](spark, small_dir), small_db, sql.statements()[name]) == []


def test_every_operator_has_one_query():
    assert [q.split("_")[0] for q in queries.queries()] == [f"op{n}" for n in range(1, 14)]
