"""Plan-shape guards: pruned scans, no nested-loop or Cartesian joins, partitioned windows."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.plans.registry import QUERIES, load_all

ML_AND_STREAMS = {"train_lr", "train_rf", "train_gbt", "smote", "rf_importance", "tune_lr", "tune_rf", "tune_gbt", "leaderboard", "leaderboard_auc_pr", "final_test",
                  "policy_document", "model_roundtrip", "feature_list_document", "stream_velocity", "stream_dedup",
                  "stream_ingest", "stream_rolling", "model_scored", "table_roundtrip", "event_log_roundtrip"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


load_all()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ML_AND_STREAMS))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _formatted(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_reads_only_needed_columns(spark):
    txt = _formatted(spark, E.queries()["fraud_rate_by_type"](spark, SF_SMALL))
    assert "ReadSchema: struct<type:string,isFraud:int>" in txt


def test_scope_filter_is_pushed_to_the_scan(spark):
    txt = _formatted(spark, E.queries()["cleaned"](spark, SF_SMALL))
    assert "PushedFilters:" in txt and "In(type, [CASH_OUT,TRANSFER])" in txt


def test_velocity_window_is_partitioned_by_destination(spark):
    txt = _plan(E.queries()["dest_velocity"](spark, SF_SMALL))
    assert "hashpartitioning(nameDest" in txt
    assert "SinglePartition" not in txt
