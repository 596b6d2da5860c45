"""Cleaning and data-quality operators on the edge cases of FIXTURES.md §B2."""

import math

import pytest

from helpers import enriched, txns
from ledgerlens.operators import quality as Q


def test_required_columns_gate(spark):
    df = enriched(spark, [{}]).drop("ip_country")
    with pytest.raises(Q.SchemaError, match="ip_country"):
        Q.require_columns(df)
    assert Q.same_columns(df, df)


def test_duplicates_counted_and_dropped(spark):
    df = enriched(spark, [{}, {}, {"amount": 5.0}])
    r = Q.duplicate_count(df).first()
    assert (r.n_rows, r.distinct_rows, r.duplicate_rows) == (3, 2, 1)
    assert Q.dedup(df).count() == 2


def test_normalise_and_vocabulary(spark):
    df = enriched(spark, [{"home_billing_country": " us "}, {"home_billing_country": "Us\t"},
                          {"home_billing_country": None}, {"ip_country": "XX"}])
    n = Q.normalise_categoricals(df)
    assert [r.home_billing_country for r in n.collect()] == ["US", "US", "NAN", "US"]
    bad = {(r.column_name, r.value): r.n_rows for r in Q.vocab_violations(n).collect()}
    assert bad == {("home_billing_country", "NAN"): 1, ("ip_country", "XX"): 1}


def test_range_and_binary_reports(spark):
    df = enriched(spark, [{"step": 0}, {"step": 744}, {"amount": -1.0}, {"ip_billing_distance_km": 23000.5},
                          {"isFraud": 2}, {"is_night": None}])
    rr = {r.column_name: r for r in Q.range_report(df).collect()}
    assert (rr["step"].n_below, rr["step"].n_above) == (1, 1)
    assert rr["amount"].n_below == 1 and rr["amount"].max_allowed is None
    assert rr["ip_billing_distance_km"].n_above == 1
    br = {r.column_name: r.n_below for r in Q.binary_report(df).collect()}
    assert br["isFraud"] == 1 and br["is_night"] == 1


def test_clean_report_counts_each_step_in_sequence(spark):
    rows = [{}, {}, {"amount": -5.0}, {"amount": 0.0}, {"step": 0}, {"amount": None},
            {"type": "PAYMENT", "amount": 7.0}, {"oldbalanceDest": 0.0, "newbalanceDest": 0.0, "amount": 3.0}]
    df = enriched(spark, rows)
    out, rep = Q.clean(df)
    r = rep.first()
    assert r.rows_in == 8 and r.duplicates_removed == 1
    assert r.missing_core_removed == 1 and r.negative_amount_removed == 1
    assert r.amount_is_zero_flagged == 1 and r.invalid_step_removed == 1
    assert r.rows_dropped_by_type_scope == 1
    assert r.rows_out == out.count() == 3
    assert "isFlaggedFraud" not in out.columns and "amount_is_zero" in out.columns


def test_nan_amount_counts_as_missing(spark):
    df = enriched(spark, [{"amount": float("nan")}, {}])
    prof = {r.column_name: r for r in Q.column_profile(df).collect()}
    assert prof["amount"].n_missing == 1 and prof["amount"].n_unique == 1
    nulls = {r.column_name: r.n_missing for r in Q.null_counts(df).collect()}
    assert nulls["ALL"] == 1


def test_contract_split_reasons(spark):
    df = txns(spark, [{}, {"amount": 0.0}, {"home_billing_country": "XX", "failed_payment_attempts": 13}, {"step": 0}])
    valid, rejected = Q.contract_split(df)
    assert valid.count() == 1
    reasons = sorted(sum((r.reject_reasons for r in rejected.collect()), []))
    assert reasons == sorted(["amount must be > 0", "unknown home_billing_country",
                              "failed_payment_attempts out of 0..12", "step must be >= 1"])


def test_fill_transaction_id_is_repeatable(spark):
    df = spark.createDataFrame([(None, 1.0), ("txn_x", 2.0)], "transaction_id string, amount double")
    a = [r.transaction_id for r in Q.fill_transaction_id(df).orderBy("amount").collect()]
    b = [r.transaction_id for r in Q.fill_transaction_id(df).orderBy("amount").collect()]
    assert a == b and a[1] == "txn_x" and a[0].startswith("txn_") and len(a[0]) == 16


def test_reconciliation_uses_isclose(spark):
    df = enriched(spark, [{"oldbalanceOrg": 100.0, "amount": 100.0, "newbalanceOrig": 1e-9}, {"newbalanceOrig": 5.0}])
    r = {x.metric: x.pct_of_rows for x in Q.reconciliation(df).collect()}
    assert math.isclose(r["orig not reconciling"], 50.0)
