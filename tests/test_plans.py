"""Physical-plan checks: no Python in the hot path, no cartesian joins, pruned scans, per-task top-k."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["missing_profile", "quality_report", "missing_cooccurrence", "top_k", "corr_matrix", "group_modes",
         "impute_tier1_train", "roc_curve", "auc_pr", "neighbour_impute", "circular_impute"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_jvm_only_and_join_safe(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_top_k_limits_per_task(spark):
    assert "WindowGroupLimit" in plan_of(E.queries()["top_k"](spark, SF))


def test_scan_reads_only_used_columns(spark):
    df = E.queries()["missing_profile"](spark, SF)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lineitem = [line for line in text.splitlines() if line.startswith("ReadSchema: struct<l_")][0]
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem
