"""Every report against its SQL, on a copy of the given tables where single keys hold a third of the rows."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entrypoint
from fleetworks.reports import REPORTS
from oracle import ORACLE
from tools.verify import TABLES, compare, duck

DATA = "/root/testdata/sf0.001"
SLOW = {"gbt_scored"}
NAMES = [n for n in REPORTS if n not in SLOW]

# a third of the rows go to one key; ORDER BY keeps the choice of rows repeatable
SKEW = {
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,"
                " CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey) FROM t",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 12 ELSE o_custkey END AS o_custkey) FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id) FROM t",
    "supplier": "SELECT * REPLACE (CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE s_nationkey END AS s_nationkey) FROM t",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment) FROM t",
}


@pytest.fixture(scope="session")
def skewed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for name in TABLES:
        source = f"{DATA}/{name}.parquet"
        if os.path.exists(source):
            query = SKEW.get(name, "SELECT * FROM t").replace("FROM t", f"FROM '{source}'")
            con.execute(f"COPY ({query}) TO '{root}/{name}.parquet' (FORMAT parquet)")
    return root


def no_pairing_and_no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


@pytest.mark.parametrize("name", NAMES)
def test_report_matches_sql_on_skewed_keys(spark, skewed, name):
    ok, detail = compare(spark, duck(skewed), skewed, name, no_pairing_and_no_python)
    assert ok, detail


@pytest.mark.parametrize("name", ["finance_monthly", "fleet_operations", "rolling_features", "work_orders_converted"])
def test_report_matches_sql_on_the_given_tables(spark, name):
    ok, detail = compare(spark, duck(DATA), DATA, name)
    assert ok, detail


def test_every_report_but_the_model_has_sql():
    assert set(ORACLE) == set(NAMES)


def test_entry(spark):
    df = entrypoint.entry(spark)
    assert len(df.columns) == 24 + 1 and df.count() > 0
