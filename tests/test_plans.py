"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entrypoint
from fleetworks.plans import finance, predictive
from fleetworks.reports import FeatureInputs
from fleetworks.session import scratch_cleared, scratch_dir, settle
from fleetworks.sources.testbed import Testbed

DATA = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def big_tables(spark):
    """Plan as if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_is_broadcast_without_a_size_check(spark, big_tables):
    for name in ("finance_monthly", "branch_performance", "fleet_operations", "work_order_costing", "parts_consumption",
                 "warehouse_inventory", "signals_triaged", "catalog_gaps", "secure_sales"):
        plan = plan_of(entrypoint.queries()[name](spark, DATA))
        # global numbering broadcasts one offset row per partition; nothing else may be broadcast
        keys = set(re.findall(r"BroadcastHashJoin \[(\w+)#", plan))
        assert keys <= {"_part"}, name


def test_grid_never_moves(spark):
    bed = Testbed(spark, DATA)
    plan = plan_of(FeatureInputs(bed).features(labelled=True))
    # every exchange sits below the explode that builds the grid, or on the sparse branches
    above_grid = plan[:plan.index("Generate explode")]
    assert "Exchange" not in above_grid
    assert len(re.findall(r"\+- Sort \[equipment_id#\d+L ASC NULLS FIRST, component_id", plan)) == 1


def test_labels_need_no_shuffle_of_the_grid(spark):
    bed = Testbed(spark, DATA)
    inputs = FeatureInputs(bed)
    spine = predictive.dense_spine(bed.equipment(), bed.components(), inputs.telemetry())
    plan = plan_of(predictive.failure_labels(spine, bed.failures()))
    assert "Exchange" not in plan[:plan.index("Generate explode")]


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entrypoint.queries()["rental_billing"](spark, DATA))
    assert "EqualTo(l_returnflag,N)" in plan
    assert "l_discount" not in plan and "l_tax" not in plan
    ratio = plan_of(entrypoint.queries()["maintenance_type_ratio"](spark, DATA))
    assert "o_totalprice" not in ratio and "IsNotNull(o_orderstatus)" in ratio.replace(" ", "") or "PushedFilters" in ratio


def test_revenue_is_summed_before_it_moves(spark):
    bed = Testbed(spark, DATA)
    plan = plan_of(finance.monthly_lines(bed.revenue_lines()))
    assert "partial_sum" in plan


def test_hot_keys_are_split_at_run_time(spark, big_tables, tmp_path):
    """A third of all lines in one order: the join reads that partition in pieces."""
    bed = Testbed(spark, DATA)
    lines = bed.raw("lineitem").withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, 7).otherwise(F.col("l_orderkey")))
    lines.repartition(16).write.parquet(str(tmp_path / "lineitem.parquet"))
    bed.raw("orders").write.parquet(str(tmp_path / "orders.parquet"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        summed = finance.monthly_lines(Testbed(spark, str(tmp_path)).revenue_lines())
        assert summed.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(summed)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_allocation_uses_one_window(spark):
    plan = plan_of(entrypoint.queries()["tax_allocated_to_month"](spark, DATA))
    assert plan.count("- Window") == 1


def test_scratch_follows_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/tmp" if key == "spark.checkpoint.dir" else default

    class Unset:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    assert scratch_dir(Session(), "x").startswith("hdfs://shared/tmp/fleetworks/x-")
    lost = Session()
    lost.conf = Unset()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(lost, "x")


def test_scratch_goes_when_the_work_is_done(spark):
    kept = settle(spark.range(3), "kept")
    with pytest.raises(ValueError), scratch_cleared(spark):
        path = settle(spark.range(3), "done").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
        raise ValueError
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3


def test_grid_is_spread(spark):
    bed = Testbed(spark, DATA)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for grid in (predictive.dense_spine(bed.equipment(), bed.components(), FeatureInputs(bed).telemetry()),
                 FeatureInputs(bed).features(labelled=True)):
        filled = grid.select(F.spark_partition_id().alias("part")).distinct().count()
        assert filled > wanted / 2
