"""Plan checks: no Python evaluation, no single-partition exchange of data
rows in the global positions, bonds broadcast in J1 at small scale."""

import re

import pytest
from pyspark.sql import functions as F

from bondliq.operators.position import global_position
from tests.single_partition import window_position
from bondliq.plans.registry import REGISTRY
from tests.conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def single_partition_inputs(plan: str) -> list[str]:
    """Input column lists of every Exchange that gathers into one partition."""
    out = []
    for block in plan.split("\n\n"):
        if re.search(r"^\(\d+\) Exchange", block, re.M) and "SinglePartition" in block:
            m = re.search(r"Input \[\d+\]: \[(.*)\]", block)
            out.append(m.group(1) if m else "")
    return out


def test_global_position_gathers_only_partition_counts(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
    order = [F.col("x").desc_nulls_last(), F.col("id").asc()]
    dist = single_partition_inputs(formatted(global_position(df, order, "p")))
    assert dist, "expected the small count table to be gathered"
    assert all(set(re.findall(r"(\w+)#", cols)) <= {"_gp_pid", "_gp_cnt"} for cols in dist)
    # the plain window form gathers the data rows themselves (the check notices it)
    plain = single_partition_inputs(formatted(window_position(df, order, "p")))
    assert any("x#" in cols for cols in plain)


def test_liquidity_table_has_no_single_partition_data_exchange(spark):
    plan = formatted(REGISTRY["liquidity_table"](spark, SF001))
    for cols in single_partition_inputs(plan):
        assert set(re.findall(r"(\w+)#", cols)) <= {"_gp_pid", "_gp_cnt"}, cols


def test_listed_quotes_broadcast_bonds_at_small_scale(spark):
    plan = formatted(REGISTRY["quotes_for_listed_bonds"](spark, SF001))
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_partkey)]" in plan


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_python_evaluation(spark, key):
    plan = formatted(REGISTRY[key](spark, SF001))
    assert not any(node in plan for node in PYTHON_NODES), key


def test_bounded_medians_use_the_window_plan(spark):
    from bondliq.operators.median import lower_median

    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "g long, v double")
    window = formatted(lower_median(df, ["g"], "v", "m"))
    assert "Window" in window and "percentile" not in window.lower()
    split = formatted(lower_median(df, ["g"], "v", "m", hot_rows=1))
    assert "Window" in split and "percentile" not in split.lower()
    assert "rangepartitioning" not in split.lower()  # the split is read back from its checkpoint
