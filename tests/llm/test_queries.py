"""The registered queries whose results SQL can express."""

from __future__ import annotations

import pytest

import __spark_entry__ as entrypoint
from fleetworks.llm.queries import ORACLE, QUERIES
from tools.verify import compare, duck

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name):
    ok, detail = compare(spark, duck(DATA), DATA, name)
    assert ok, detail


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entrypoint.queries()) and set(ORACLE) <= set(entrypoint.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} - {"pipeline"}
