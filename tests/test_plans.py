"""Physical-plan checks over every registered query: no cartesian product,
no nested-loop join, no window without a partition spec (global window),
and column pruning at the scan."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# queries that write (and read back) during construction are checked elsewhere
SIDE_EFFECTS = {"s1_bar_csv_scan", "s11_partitioned_store", "s15_manifest", "i2_stream_upsert", "i5_publish_plan",
                "i6_stream_bars", "a6_live_series_counts"}
NAMES = sorted(n for n in E.queries() if n not in SIDE_EFFECTS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(df):
    """All physical operators of the plan (through the adaptive wrapper)."""
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        yield node
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.inputPlan())
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))


def _global_windows(df) -> int:
    return sum(1 for n in _nodes(df) if n.getClass().getSimpleName() in ("WindowExec", "WindowGroupLimitExec")
               and n.partitionSpec().isEmpty())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert _global_windows(df) == 0, plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["a7_return_description"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_orderpriority" not in schema and "o_totalprice" in schema


def test_global_window_is_detected(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("rn", F.row_number().over(Window.orderBy("id")))
    assert _global_windows(df) == 1
    keyed = spark.range(10).withColumn("rn", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert _global_windows(keyed) == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", ["i6_bars_from_ticks", "a2_intraday_merge", "a1_incremental_merge",
                                  "w1_last_write_wins"])
def test_hash_aggregation_with_map_side_combine(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "SortAggregate" not in plan
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_max_by|partial_min_by", plan)
