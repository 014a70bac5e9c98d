"""Plan shapes that matter at scale, read from the public ``explain``."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ridelens.operators.rollup import time_rollup
from ridelens.plans import fixtures
from ridelens.plans.composite import clean_trips_table, rides_narrow, analysis_rides

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_clean_filters_reach_the_scan(spark):
    v = fixtures.load(spark, SF)
    plan = plan_of(clean_trips_table(v["trips_raw"]))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan)
    assert any("IsNotNull(ride_id)" in p and "IsNotNull(end_lng)" in p for p in pushed)


def test_month_range_prunes_partitions(spark):
    v = fixtures.load(spark, SF)
    plan = plan_of(v["trips_raw"].filter(F.col("source_month").between("202403", "202405")).select("ride_id"))
    assert "PartitionFilters: [isnotnull(source_month" in plan
    assert "ReadSchema: struct<ride_id:string>" in plan


def test_station_dimension_is_broadcast(spark):
    v = fixtures.load(spark, SF)
    plan = plan_of(rides_narrow(v["trips_raw"], v["stations_raw"], materialize=False))
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan


def test_zscore_reads_one_column_for_its_statistics(spark):
    v = fixtures.load(spark, SF)
    plan = plan_of(analysis_rides(v["trips_raw"]))
    assert "ReadSchema: struct<duration:int>" in plan
    assert "Subquery" in plan and "NestedLoopJoin" not in plan


def _single_partition_inputs(plan: str) -> list[str]:
    """For every exchange to a single partition, the operator feeding it."""
    tree = plan.split("\n\n")[0].splitlines()
    out = []
    for i, line in enumerate(tree):
        m = re.search(r"Exchange \((\d+)\)", line)
        if not m:
            continue
        details = re.search(rf"\({m.group(1)}\) Exchange\n(?:.+\n)*?Arguments: (\w+)", plan)
        if details and details.group(1) == "SinglePartition":
            child = re.search(r"(\w+) \((\d+)\)", tree[i + 1].split("+-")[-1])
            body = re.search(rf"\({child.group(2)}\) {child.group(1)}\n((?:.+\n)+)", plan).group(1)
            out.append(child.group(1) + (" partial" if "partial_" in body else ""))
    return out


def test_no_single_partition_step_on_rows(spark):
    v = fixtures.load(spark, SF)
    for df in (analysis_rides(v["trips_raw"]), time_rollup(analysis_rides(v["trips_raw"]))):
        plan = plan_of(df)
        assert "Window" not in plan
        # Only global aggregates meet in one partition, as one partial row per task.
        inputs = _single_partition_inputs(plan)
        assert all(x == "HashAggregate partial" for x in inputs)
        assert "NestedLoopJoin" not in plan
