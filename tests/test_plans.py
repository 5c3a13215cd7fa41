"""Plan guards over every registered query: no Python evaluation, no window
without a partition (a whole table in one task), and no cartesian or
nested-loop join except inside Spark ML's all-users top-N."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

QUERIES = E.queries()
# Spark ML's recommendForAllUsers / recommendForUserSubset cross-join factor
# blocks by definition (users × items); that is the library, not our plan
ML_TOPN = {"als_recommendation_lines", "als_topn", "als_topn_subset", "als_save_reload_topn"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_windows(plan):
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Window [" in line and "WindowGroupLimit" not in line:
            below = lines[i + 1:i + 4]
            if any("Exchange SinglePartition" in x for x in below):
                bad.append(line.strip()[:120])
    return bad


def test_guard_detects_unpartitioned_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert _single_partition_windows(_plan(df))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in plan
    assert not _single_partition_windows(plan)
    if name not in ML_TOPN:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
