"""Plan guards for the core operators: no cross products, no nested-loop joins,
scans prune columns and push filters."""

import pytest

import __spark_entry__ as E

CORE = ["first_per_key", "latest_per_key", "asof_ttl", "asof_now", "stratified_split", "hash_sample",
        "rolling_rows", "roc_auc", "counter_rate", "sustained_alert", "wasserstein_norm", "code_groups"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", CORE)
def test_no_cross_products(spark, small_dir, key):
    plan = _plan(E.queries()[key](spark, small_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_and_pushes(spark, small_dir):
    df = E.queries()["asof_ttl"](spark, small_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_first_per_key_is_an_aggregate_not_a_window(spark, small_dir):
    plan = _plan(E.queries()["first_per_key"](spark, small_dir))
    assert "Window" not in plan and "partial_min" in plan
