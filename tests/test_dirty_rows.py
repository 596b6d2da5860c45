"""Dirty rows: NaN, NULL, text case, zero divisors and bad stamps; expected values written by hand."""

import math

from pyspark.sql import functions as F

from helpers import enriched, txns
from ledgerlens.operators import features as FE
from ledgerlens.operators import quality as Q
from ledgerlens.sources import events as EV
from ledgerlens.streaming import jobs as J

NAN = float("nan")


def test_missing_amounts_never_pass(spark):
    df = enriched(spark, [{"amount": 1.0}, {"amount": -1.0}, {"amount": NAN}, {"amount": None}])
    assert [r.amount for r in Q.amount_filter(df).collect()] == [1.0]
    out, report = Q.clean(df)
    r = report.first()
    assert out.count() == 1 and (r.missing_core_removed, r.negative_amount_removed, r.rows_out) == (2, 1, 1)


def test_missing_type_and_step_count_as_missing_core(spark):
    df = enriched(spark, [{}, {"type": None}, {"step": None}, {"step": 12_000}, {"step": 0}, {"type": "PAYMENT"}])
    out, report = Q.clean(df)
    r = report.first()
    assert (r.rows_in, r.missing_core_removed, r.invalid_step_removed, r.rows_dropped_by_type_scope, r.rows_out) == (6, 2, 2, 1, 1)
    assert out.count() == 1


def test_range_report_leaves_nan_out(spark):
    df = enriched(spark, [{"amount": NAN}, {"amount": 5.0}, {"amount": -2.0}])
    r = {x.column_name: x for x in Q.range_report(df).collect()}["amount"]
    assert (r.n_below, r.n_above, r.observed_min, r.observed_max) == (1, 0, -2.0, 5.0)


def test_flags_of_missing_values_are_zero(spark):
    df = txns(spark, [{"account_age_days": None, "failed_payment_attempts": None, "oldbalanceOrg": None, "oldbalanceDest": None, "type": None}])
    r = FE.row_features(df).first()
    assert (r.young_account, r.high_failed_attempts, r.drained_origin, r.origin_emptied, r.dest_balances_masked, r.is_transfer) == (0,) * 6
    q = Q.quality_flags(df.withColumn("amount", F.lit(None).cast("double"))).first()
    assert (q.amount_is_zero, q.dest_balance_unknown, q.orig_balance_unknown, q.invalid_amount_flag) == (0,) * 4


def test_balance_of_minus_one_gives_no_ratio(spark):
    rows = FE.row_features(txns(spark, [{"oldbalanceOrg": -1.0}, {"oldbalanceOrg": 99.0, "amount": 50.0}])).collect()
    assert rows[0].amount_to_oldbalanceOrg is None and math.isclose(rows[1].amount_to_oldbalanceOrg, 0.5)


def test_rows_that_normalising_makes_equal_stay_two(spark):
    df = enriched(spark, [{"ip_country": "US"}, {"ip_country": " us "}, {"ip_country": "US"}])
    after = Q.amount_filter(Q.normalise_categoricals(Q.dedup(df)))
    assert [r.ip_country for r in after.collect()] == ["US", "US"]


def test_vocab_violations_are_reported(spark):
    df = enriched(spark, [{}, {"type": "GIFT"}, {"ip_country": "XX"}, {"ip_country": "XX"}])
    got = {(r.column_name, r.value): r.n_rows for r in Q.vocab_violations(df).collect()}
    assert got == {("type", "GIFT"): 1, ("ip_country", "XX"): 2}


def test_contract_rejects_with_reasons(spark):
    valid, rejected = Q.contract_split(enriched(spark, [{}, {"amount": 0.0}, {"type": "GIFT", "step": 0}]))
    assert valid.count() == 1
    assert sorted(sorted(r.reject_reasons) for r in rejected.collect()) == [["amount must be > 0"], ["step must be >= 1", "unknown type"]]


def test_bad_stamp_is_null_and_blank_lines_are_skipped(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("yesterday",), (None,)], "event_time_utc string")
    assert [r.event_time is None for r in J.event_time(df).collect()] == [False, True, True]
    lines = spark.createDataFrame([("\t",), ("  ",), ("",), ("{bad",), ('{"type": "TRANSFER"}',)], "value string")
    r = EV.tolerant_summary(EV.parse_lines(lines)).first()
    assert (r.n_lines, r.blank_lines, r.malformed_lines, r.parsed_events) == (5, 3, 1, 1)


def test_a_missing_decision_is_no_alarm(spark):
    lines = spark.createDataFrame([('{"transaction_id": "a", "type": "TRANSFER"}',)], "value string")
    r = EV.event_frame(EV.good_events(EV.parse_lines(lines))).first()
    assert (r.prediction, r.step, r.nameDest) == (0, 744, "UNKNOWN_DEST")


def test_rolling_windows_from_hours(spark):
    hours = spark.createDataFrame([(1, 2, 1, 1, 1), (3, 1, 0, 1, 0)], "step long, n long, fraud long, flagged long, tp long")
    got = {r.window_end_step: (r.n, r.fraud) for r in J.rolling_from_hours(hours, 3).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (3, 1), 4: (1, 0), 5: (1, 0)}
