"""Features, evaluation and monitoring on hand-made edge cases and brute-force references."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import txns
from ledgerlens.operators import evaluate as M
from ledgerlens.operators import explore as X
from ledgerlens.operators import features as FE
from ledgerlens.operators import monitor as MN
from ledgerlens.operators import prep as P
from ledgerlens.operators import score as SC


def _velocity_rows(spark, threshold):
    rows = [{"nameDest": "C1", "step": 5}, {"nameDest": "C1", "step": 5}, {"nameDest": "C1", "step": 3},
            {"nameDest": "C2", "step": 9}, {"nameDest": "C1", "step": 10}]
    v = FE.dest_velocity(txns(spark, rows), hot_threshold=threshold)
    return {r.txn_id: (r.dest_prior_count, r.dest_steps_since_last, r.dest_first_seen) for r in v.collect()}


@pytest.mark.parametrize("threshold", [None, 1])
def test_velocity_same_step_repeats_and_hot_path(spark, threshold):
    got = _velocity_rows(spark, threshold)
    # order within C1: (3, id3), (5, id1), (5, id2), (10, id5)
    assert got[3] == (0, -1.0, 1)
    assert got[1] == (1, 2.0, 0)
    assert got[2] == (2, 0.0, 0)
    assert got[5] == (3, 5.0, 0)
    assert got[4] == (0, -1.0, 1)


def test_prior_amount_hot_and_cold_agree(spark):
    rows = [{"nameDest": "C1", "step": s % 7, "amount": float(s)} for s in range(40)]
    df = txns(spark, rows)
    a = {r.txn_id: r.dest_prior_amount_sum for r in FE.dest_prior_amount(df).collect()}
    b = {r.txn_id: r.dest_prior_amount_sum for r in FE.dest_prior_amount(df, hot_threshold=5).collect()}
    assert a == pytest.approx(b)


def test_deciles_for_n_not_divisible_by_ten(spark):
    n = 23
    rows = [{"account_age_days": i % 5, "isFraud": int(i % 3 == 0)} for i in range(n)]
    d = X.rank_deciles(txns(spark, rows), ["account_age_days"])
    counts = {r.decile: r.n for r in d.collect()}
    assert sum(counts.values()) == n
    # pandas qcut(rank, 10) bin sizes for n = 23
    r = np.arange(1, n + 1)
    exp = np.maximum(np.ceil((r - 1) * 10 / (n - 1)), 1) - 1
    assert counts == {int(k): int(v) for k, v in zip(*np.unique(exp, return_counts=True))}


def test_robust_scaler_all_equal_column(spark):
    df = txns(spark, [{"amount": 5.0, "step": i} for i in range(1, 6)])
    st = {r.feature: (r.center, r.scale) for r in P.robust_stats(df, ["amount", "step"]).collect()}
    assert st["amount"] == (5.0, 1.0)
    assert st["step"] == (3.0, 2.0)
    v = {r.feature: r.dropped for r in P.variance_filter(df, ["amount", "step"]).collect()}
    assert v == {"amount": True, "step": False}


def test_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    n = 300
    score = np.round(rng.random(n) ** 2, 4)
    y = (rng.random(n) < score * 0.5).astype(int)
    amt = np.round(rng.random(n) * 100, 2)
    df = spark.createDataFrame([(int(i), float(s), int(t), float(a)) for i, (s, t, a) in enumerate(zip(score, y, amt))],
                               "txn_id long, score double, isFraud int, amount_raw double")
    sw = {r.threshold: r for r in M.threshold_sweep(df).collect()}
    for t in M.threshold_grid()[::17]:
        pred = score >= t
        fn = (y == 1) & ~pred
        fp = (y == 0) & pred
        assert sw[t].n_fp == fp.sum() and sw[t].n_fn == fn.sum()
        assert sw[t].net_cost == pytest.approx(amt[fn].sum() + 10 * fp.sum(), abs=1e-6)
    # AP and AUC against their definitions
    ap = M.average_precision(df).first().average_precision
    order = np.argsort(-score, kind="stable")
    ds = np.unique(score)[::-1]
    tot = y.sum()
    exp_ap = 0.0
    for s in ds:
        sel = score >= s
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        exp_ap += ((y[score == s] == 1).sum() / tot) * prec
    assert ap == pytest.approx(exp_ap, abs=1e-12)
    del order
    pos, neg = score[y == 1], score[y == 0]
    exp_auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert M.roc_auc(df).first().roc_auc == pytest.approx(exp_auc, abs=1e-12)


def test_review_budget_ties_by_id(spark):
    df = spark.createDataFrame([(i, 0.5, int(i == 3), 1.0) for i in range(10)], "txn_id long, score double, isFraud int, amount_raw double")
    rb = {r.review_budget_pct: r for r in M.review_budget(df, [0.1, 0.4]).collect()}
    assert rb[10.0].flagged_rows == 1 and rb[10.0].fraud_caught == 0
    assert rb[40.0].flagged_rows == 4 and rb[40.0].fraud_caught == 1


def test_no_admissible_threshold_raises(spark):
    df = spark.createDataFrame([(1, 1.0, 1, 5.0)], "txn_id long, score double, isFraud int, amount_raw double")
    with pytest.raises(ValueError, match="send all rows to review"):
        M.choose_threshold(df)


def test_chi2_constant_feature_and_single_class_window(spark):
    ref = spark.createDataFrame([(0, 1)] * 5, "a int, b int")
    cur = spark.createDataFrame([(0, 0)] * 3, "a int, b int")
    d = {r.feature: r for r in MN.drift_summary(ref, cur, ["a", "b"]).collect()}
    assert d["a"].p_value == 1.0 and not d["a"].drifted
    assert d["b"].method == "chi2_binary"
    cur2 = spark.createDataFrame([(1, 0, 0, 0.3), (2, 0, 0, 0.2)], "step long, target int, prediction int, prediction_proba double")
    ap = MN.rolling_average_precision(cur2).collect()
    assert all(r.average_precision is None for r in ap)


def test_scoring_override_and_dry_run(spark):
    df = txns(spark, [{"nameDest": "C1", "step": 1}, {"nameDest": "C1", "step": 2},
                      {"nameDest": "C1", "step": 3, "type": "PAYMENT"}, {"nameDest": "C1", "step": 4}])
    df = df.withColumn("dest_prior_count", F.when(F.col("txn_id") == 2, F.lit(7)).cast("long"))
    s = {r.txn_id: r for r in SC.score_batch(df, "score", 0.05).collect()}
    assert s[2].dest_prior_count == 7 and s[2].dest_first_seen == 0
    assert s[4].dest_prior_count == 1 and s[4].dest_steps_since_last == 3.0
    assert s[3].decision == "AUTO_APPROVE" and s[3].fraud_probability is None and s[3].risk_signals == []
    assert s[1].decision == "REVIEW" and "night-time transaction (00:00-05:59)" in s[1].risk_signals
    dry = {r.txn_id: r.dest_prior_count for r in SC.score_batch(df, "score", 0.05, update_state=False).collect()}
    assert dry[4] == 0


def test_smoke_transaction_fires_all_signals(spark):
    req = spark.createDataFrame(
        [(1, "TRANSFER", 8500.0, 744, 20, 1, 1, 4, 4200.0, "US", "NG", "C9999999")],
        "txn_id long, type string, amount double, step long, account_age_days long, is_new_device int, "
        "shipping_billing_mismatch int, failed_payment_attempts long, ip_billing_distance_km double, "
        "home_billing_country string, ip_country string, nameDest string")
    r = SC.score_batch(req, F.lit(0.9), 0.5).first()
    assert r.decision == "REVIEW" and len(r.risk_signals) == 7
    assert r.reason == "score 0.9000 vs policy threshold 0.5 (score, behavioural variant)"


def test_ks_statistic_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 200), 2), np.round(rng.normal(0.3, 1, 120), 2)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    d = MN.drift_summary(ref, cur, ["x"]).first()
    grid = np.union1d(a, b)
    exp = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert d.score == pytest.approx(exp, abs=1e-12)
    assert 0.0 <= d.p_value <= 1.0


def test_erfc_accuracy(spark):
    xs = [0.0, 0.1, 0.5, 1.0, 2.0, 3.5, -0.7]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(M.erfc(F.col("x")).alias("e")).collect()
    for x, r in zip(xs, got):
        assert r.e == pytest.approx(math.erfc(x), rel=2e-7)


def test_stratified_cap_brute_force(spark):
    import hashlib

    rows = [{"isFraud": int(i % 9 == 0)} for i in range(200)]
    df = txns(spark, rows).select("txn_id", "isFraud")
    got = {r.txn_id for r in P.stratified_cap(df, 50, 42).collect()}
    frac = 50 / 200
    exp = set()
    for cls in (0, 1):
        ids = [i + 1 for i, r in enumerate(rows) if r["isFraud"] == cls]
        key = sorted(ids, key=lambda t: (int(hashlib.md5(f"42:{t}".encode()).hexdigest()[:15], 16), t))
        exp |= set(key[: int(round(len(ids) * frac))])
    assert got == exp


def test_rolling_average_precision_over_many_buckets_equals_brute_force(spark):
    import random

    rng = random.Random(4)
    # ties, a score shared by a third of the rows, unlabelled rows and steps without rows
    rows = [(rng.choice([1, 2, 3, 5, 9, 10, 11, 14]), rng.choice([0, 0, 0, 1, None]), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "step long, target int, prediction_proba double")
    got = {r["window_end_step"]: r["average_precision"] for r in MN.rolling_average_precision(df, window=4, positives_per_bucket=3).collect()}
    labelled = [r for r in rows if r[1] is not None]
    assert set(got) == {s for s, _, _ in labelled}
    for end, value in got.items():
        w = [(y, p) for s, y, p in labelled if end - 4 < s <= end]
        n_pos = sum(y for y, _ in w)
        want = sum(sum(y for y, p in w if p == t) / n_pos * sum(y for y, p in w if p >= t) / sum(p >= t for _, p in w) for t in {p for _, p in w})
        assert value == pytest.approx(want, abs=1e-12)
    one = df.where("target = 1")
    assert {r["average_precision"] for r in MN.rolling_average_precision(one, window=4).collect()} == {None}
    assert MN.rolling_average_precision(df.limit(0), window=4).count() == 0
