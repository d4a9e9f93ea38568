from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fleetworks.plans import governance, quality
from fleetworks.schemas import CONSTRAINTS, TABLES, Constraints
from fleetworks.session import settle
from tests.conftest import tuples

CUSTOMERS = [(1, "Western"), (2, "Greater Accra"), (3, "Ahafo"), (4, None)]


def view(frame, role):
    customers = frame("customer_id long, region string", CUSTOMERS)
    sales = frame("customer_id long, sale_id long", [(1, 10), (2, 20), (2, 21), (3, 30)])
    sites = frame("customer_id long, site_id long", [(1, 1), (2, 2)])
    seen = governance.secure_view({"customers": customers, "sales": sales, "sites": sites}, role)
    return {name: df.count() for name, df in seen.items()}


def test_row_security(frame):
    assert view(frame, "analyst") == {"customers": 3, "sales": 4, "sites": 2}
    assert view(frame, "analyst_accra") == {"customers": 1, "sales": 2, "sites": 1}
    assert view(frame, "analyst_western") == {"customers": 1, "sales": 1, "sites": 1}
    assert view(frame, "nobody") == {"customers": 0, "sales": 0, "sites": 0}
    assert view(frame, "etl") == {"customers": 4, "sales": 4, "sites": 2}


def test_audit_log(frame):
    schema = "id long, v string"
    before = frame(schema, [(1, "same"), (2, "old"), (3, "gone"), (4, None)])
    after = frame(schema, [(1, "same"), (2, "new"), (5, "fresh"), (4, None)])
    log = {r["id"]: r for r in governance.audit_diff(before, after, ["id"], "t", "me").collect()}
    assert {k: r["operation"] for k, r in log.items()} == {2: "UPDATE", 3: "DELETE", 5: "INSERT"}
    assert json.loads(log[2]["old_data"])["v"] == "old" and json.loads(log[2]["new_data"])["v"] == "new"
    assert log[3]["new_data"] is None and log[5]["old_data"] is None and log[5]["db_user"] == "me"


@pytest.mark.parametrize("width", [None, 10])
def test_audit_of_changed_parts_equals_the_whole_audit(spark, frame, width):
    rng = random.Random(3)
    rows = {k: rng.randrange(5) for k in range(-60, 400) if rng.random() < 0.9}
    after = {k: v + (k % 9 == 0 and -20 < k < 40) for k, v in rows.items() if k not in (100, 101, -50)} | {1000: 1, -1000: 2, -7: 9}
    schema = "id long, v int"
    a, b = frame(schema, list(rows.items())), frame(schema, list(after.items()))
    whole = governance.audit_diff(a, b, ["id"], "t", "me", dt.datetime(2024, 1, 1))
    for parts in (64, 1):
        some = governance.audit_changed_parts(a, b, ["id"], "t", "me", dt.datetime(2024, 1, 1), parts=parts, width=width)
        assert tuples(some) == tuples(whole) and whole.count() > 5


def test_unchanged_ranges_ship_no_row_images(spark, frame, tmp_path):
    spark.range(5000).selectExpr("id", "id % 7 AS v").repartitionByRange(5, "id").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    b = a.withColumn("v", F.when(F.col("id") == 1234, 99).otherwise(F.col("v")))
    part = F.expr("id div 100")
    assert tuples(governance.changed_parts(a, b, part)) == [(12,)]
    log = governance.audit_changed_parts(a, b, ["id"], "t", "me", width=100)
    assert [(r["id"], r["operation"]) for r in log.collect()] == [(1234, "UPDATE")]
    plan = log._jdf.queryExecution().executedPlan().toString()
    # the range reaches the scan, below every shuffle of row images
    assert plan.count("GreaterThanOrEqual(id,1200)") == plan.count("FileScan parquet") > 0


KEYS = [(1, b"0123456789abcdef"), (2, b"fedcba9876543210" * 2)]


def sealed(spark, frame):
    keys = frame("key_id int, secret binary", [(k, bytearray(s)) for k, s in KEYS])
    df = frame("id long, part int, name string", [(1, 1, "Ama"), (1, 2, "Kofi"), (2, 1, None)])
    return keys, settle(governance.encrypt_rows(df, "name", keys, F.lit(1), "people", ["id", "part"]), "sealed")


def test_keys_live_side_by_side_and_rotate(spark, frame):
    keys, locked = sealed(spark, frame)
    mixed = settle(governance.rotate_key(locked.filter("part = 1"), "name", keys, [1], 2, "people", ["id", "part"]).unionByName(
        locked.filter("part = 2")), "mixed")
    opened = governance.decrypt_rows(mixed, "name", keys, "people", ["id", "part"])
    assert tuples(opened, "id", "part", "name", "name_key") == [(1, 1, "Ama", 2), (1, 2, "Kofi", 1), (2, 1, None, 2)]
    only_new = governance.decrypt_rows(mixed, "name", keys.filter("key_id = 2"), "people", ["id", "part"])
    assert tuples(only_new, "id", "part", "name") == [(1, 1, "Ama"), (1, 2, None), (2, 1, None)]
    # rows under other keys are left alone
    again = governance.rotate_key(mixed, "name", keys, [7], 2, "people", ["id", "part"])
    assert tuples(again.select("id", "part", F.hex("name"))) == tuples(mixed.select("id", "part", F.hex("name")))


def test_ciphertexts_belong_to_their_row_and_table(spark, frame):
    keys, locked = sealed(spark, frame)
    moved = locked.withColumn("part", 3 - F.col("part"))
    for table, rows in (("people", moved), ("others", locked), ("people", locked.withColumn("name", F.reverse(F.hex("name")).cast("binary")))):
        assert governance.decrypt_rows(rows, "name", keys, table, ["id", "part"]).filter("name is not null").count() == 0
    with pytest.raises(Exception, match="can't be opened"):
        governance.rotate_key(moved, "name", keys, [1], 2, "people", ["id", "part"]).collect()
    with pytest.raises(Exception, match="no key named"):
        governance.encrypt_rows(frame("id long, name string", [(1, "x")]), "name", keys, F.lit(9), "people", ["id"]).collect()


def test_encryption_hides_and_restores(frame):
    df = frame("id long, name string", [(1, "Ama Mensah"), (2, None)])
    key = F.lit("0123456789abcdef").cast("binary")
    locked = governance.encrypt_column(df, "name", key)
    assert dict(locked.dtypes)["name"] == "binary" and b"Ama" not in bytes(locked.filter("id = 1").first()["name"])
    assert tuples(governance.decrypt_column(locked, "name", key)) == [(1, "Ama Mensah"), (2, None)]


def test_single_checks(frame):
    df = frame("k long, v string", [(1, "a"), (1, "b"), (None, "x"), (None, None)])
    assert tuples(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert quality.null_rows(df, "k").count() == 2
    assert tuples(quality.unlisted_values(df, "v", ["a", "b"]), "v") == [("x",)]
    assert tuples(quality.orphans(df, "k", frame("id long", [(2,)]), "id"), "v") == [("a",), ("b",)]


def test_declared_constraints_find_planted_faults(frame):
    tables = {
        "dim_industry": frame("industry_id long, industry_name string", [(1, "Mining"), (2, "Mining")]),
        "dim_customer": frame(
            "customer_id long, customer_code string, customer_name string, customer_type string, industry_id long,"
            " region string, contract_tier string", [
                (1, "A", "n", "Contract Miner", 1, "r", "Gold"), (1, "B", None, "Nobody", 7, "r", None)]),
    }
    alone = {r["check_name"]: r["violations"] for r in quality.check_constraints({"dim_customer": tables["dim_customer"]}).collect()}
    assert alone["dim_customer: industry_id in dim_industry (not checked)"] is None
    found = {r["check_name"]: r["violations"] for r in quality.check_constraints(tables).collect() if r["violations"]}
    assert found == {
        "dim_industry: industry_name unique": 1, "dim_customer: customer_name not null": 1,
        "dim_customer: customer_type in domain": 1, "dim_customer: customer_id unique": 1,
        "dim_customer: industry_id in dim_industry": 1}


def test_all_rules_share_one_shuffle_and_one_scan_a_table(spark, frame, tmp_path):
    for name, rows in (("a", [(1, 2, "x"), (1, 9, "y"), (None, None, None)]), ("b", [(2, 1, "x")] * 3 + [(3, 7, "z")])):
        frame("k long, other int, v string", rows).write.parquet(str(tmp_path / name))
    declared = {
        "a": Constraints(("k",), ("v",), (("k", "v"),), {"other": ("b", "k")}, {"v": ["x"]}, {"k is one": "k <> 1"}),
        "b": Constraints(("k", "v"), (), (("v",),), {"other": ("a", "k")})}
    report = quality.check_constraints({n: spark.read.parquet(str(tmp_path / n)) for n in "ab"}, declared)
    assert tuples(report) == [
        ("a: k is one", 0), ("a: k not null", 1), ("a: k unique", 1), ("a: k+v unique", 0), ("a: other in b", 1),
        ("a: v in domain", 1), ("a: v not null", 1), ("b: k not null", 0), ("b: k+v unique", 1), ("b: other in a", 1),
        ("b: v not null", 0), ("b: v unique", 1)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    assert final.count("FileScan parquet") == 2 and final.count("hashpartitioning(rule") == 2


def test_every_constraint_names_real_columns():
    columns = {t: {c.strip().split(" ")[0] for c in ddl.split(", ")} for t, ddl in TABLES.items()}
    for table, rules in CONSTRAINTS.items():
        named = {*rules.key, *rules.not_null, *rules.references, *rules.allowed, *(c for k in rules.unique for c in k)}
        assert named <= columns[table], table
        for parent, column in rules.references.values():
            assert column in columns[parent]
    assert len(CONSTRAINTS) == 26


def test_result_checks(frame):
    inventory = frame("part_id long, branch string, snapshot_date date, unit_cost_ghs double, inventory_value_ghs double", [
        (1, "Accra", None, 1.0, -5.0), (1, "Lagos", None, None, 5.0)])
    signals = frame("signal_id long, failure_probability double, signal_status string", [(1, 1.5, "New"), (1, 0.5, "Odd")])
    found = {r["check_name"]: r["violations"] for r in quality.check_results(
        {"warehouse_inventory": inventory, "predictive_signals": signals}).collect() if r["violations"]}
    assert found == {
        "warehouse_inventory: snapshot_date not null": 2, "warehouse_inventory: unit_cost_ghs not null": 1,
        "warehouse_inventory: branch in domain": 1, "warehouse_inventory: inventory value not negative": 1,
        "predictive_signals: signal_status in domain": 1, "predictive_signals: failure probability in range": 1,
        "predictive_signals: signal_id unique": 1}


def test_rules_are_tagged_in_generated_code_and_keys_stay_exact(frame):
    tables = {
        "a": frame("k int, day date, v string, other string", [
            (1, dt.date(1970, 1, 2), "x", "1"), (1, dt.date(1970, 1, 2), "y", "3"), (2, dt.date(1970, 1, 3), "x", None), (None, None, None, "2")]),
        "b": frame("k long, day date, n int, text string", [
            (1, dt.date(1970, 1, 2), 1, "1"), (2, dt.date(1970, 1, 4), 2, "2"), (2**40, None, None, "x"), (2, dt.date(1970, 1, 4), 9, "2")])}
    declared = {
        "a": Constraints(("k", "day"), ("v",), (("k", "v"), ("k", "day", "v")), {"k": ("b", "k"), "day": ("b", "day"), "other": ("b", "k")}),
        "b": Constraints(("k",), (), (("day", "k"),), {"n": ("a", "k"), "day": ("a", "day"), "text": ("a", "k"), "k": ("a", "day")})}
    report = quality.check_constraints(tables, declared)
    assert tuples(report) == [
        ("a: day in b", 1), ("a: day not null", 1), ("a: k in b", 0), ("a: k not null", 1), ("a: k+day unique", 1),
        ("a: k+day+v unique", 0), ("a: k+v unique", 0), ("a: other in b", 1), ("a: v not null", 1),
        ("b: day in a", 2), ("b: day+k unique", 1), ("b: k in a", 4), ("b: k not null", 0), ("b: k unique", 1),
        ("b: n in a", 1), ("b: text in a", 1)]
    # a lambda over the array would be interpreted for every row, with all rules inside it
    assert "lambda" not in report._jdf.queryExecution().executedPlan().toString()
