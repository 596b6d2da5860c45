"""Scoring with a saved model: probabilities equal the logistic function of its coefficients, worked out by hand."""

import math

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import features as FE
from ledgerlens.operators import score as SC
from ledgerlens.plans import ml
from ledgerlens.sources.fixture import transactions


def test_model_probability_equals_the_logistic_function(spark):
    model, stats, policy = ml._saved_parts(spark, SF_SMALL)
    t = transactions(spark, SF_SMALL)
    got = {r.txn_id: r for r in SC.score_with_model(t, model, stats, policy).select("txn_id", "type", "decision", "fraud_probability").collect()}
    lr = model.stages[-1]
    raw = FE.one_hot(FE.row_features(SC.scoring_velocity(SC.request_defaults(t)))).where(F.col("type").isin("TRANSFER", "CASH_OUT"))
    n = 0
    for r in raw.collect():
        z = lr.intercept
        for name, w in zip(ml.BEHAVIOURAL, lr.coefficients):
            x = float(r[name])
            if name in stats:
                x = (x - stats[name][0]) / stats[name][1]
            z += w * x
        p = 1 / (1 + math.exp(-z))
        assert math.isclose(got[r.txn_id].fraud_probability, p, rel_tol=1e-6, abs_tol=1e-9)
        assert got[r.txn_id].decision == ("REVIEW" if p >= policy["threshold"] else "APPROVE")
        n += 1
    assert n > 50
    assert {r.decision for r in got.values() if r.type not in ("TRANSFER", "CASH_OUT")} == {"AUTO_APPROVE"}
    assert {"txn_id", "amount", "account_age_days"} <= set(SC.score_with_model(t, model, stats, policy).columns)


def test_only_rows_without_a_logged_probability_are_scored(spark):
    from ledgerlens.plans.monitor import event_features

    model, stats, _ = ml._saved_parts(spark, SF_SMALL)
    ev = event_features(spark, SF_SMALL).withColumn("prediction_proba", F.when(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) > 0, F.col("prediction_proba")))
    before = {r.transaction_id: r for r in ev.collect()}
    lr = model.stages[-1]

    def probability(r):
        z = lr.intercept
        for name, w in zip(ml.BEHAVIOURAL, lr.coefficients):
            x = float(r[name])
            z += w * ((x - stats[name][0]) / stats[name][1] if name in stats else x)
        return 1 / (1 + math.exp(-z))

    got = {r.transaction_id: r for r in SC.fill_scores(ev, model, stats, 0.05).collect()}
    assert set(got) == set(before) and len(got) > 20
    for i, r in before.items():
        if r.prediction_proba is not None:
            assert got[i].prediction_proba == r.prediction_proba
        else:
            assert math.isclose(got[i].prediction_proba, probability(r), rel_tol=1e-6, abs_tol=1e-9)
        assert got[i].prediction == r.prediction and got[i].dest_prior_count == r.dest_prior_count
    # a log without decisions is judged by the threshold
    free = {r.transaction_id: r for r in SC.fill_scores(ev, model, stats, 0.05, decided=False).collect()}
    assert all(r.prediction == int(r.prediction_proba >= 0.05) for r in free.values())


def test_latest_decision_of_a_case_stands(spark):
    scored = spark.createDataFrame(
        [(1, 10, "REVIEW", 1, 5.0), (2, 10, "BLOCK", 0, 7.0), (3, 10, "REVIEW", 1, 11.0), (4, 10, "APPROVE", 1, 13.0), (5, 10, "REVIEW", 0, 1.0), (6, 10, "REVIEW", 0, 2.0)],
        "txn_id long, step long, decision string, isFraud int, amount double")
    log = spark.createDataFrame(
        [(1, "legit", 12), (1, "fraud", 15), (1, "legit", 14), (2, "fraud", 11), (2, "fraud", 11), (3, "legit", 20), (3, "fraud", 9), (4, "fraud", 30),
         (5, "unsure", 12), (6, "legit", 12), (6, "fraud", 12), (99, "fraud", 50), (None, "fraud", 50), (5, "fraud", None)],
        "txn_id long, analyst_decision string, decided_at long")
    r = SC.resolve_cases(scored, log.repartition(3))
    assert {x.txn_id: (x.analyst_decision, x.decided_at) for x in r.collect()} == {
        1: ("fraud", 15), 2: ("fraud", 11), 3: ("legit", 20), 5: (None, None), 6: ("fraud", 12)}
    k = SC.case_kpis(r).first().asDict()
    assert k == {"resolved": 4, "pending": 1, "caught_count": 1, "caught_value": 5.0, "released_in_error": 1, "released_value": 11.0,
                 "wrong_blocks": 2, "queue_precision": 0.5, "correct_share": 0.25}
    empty = SC.case_kpis(SC.resolve_cases(scored, log.limit(0))).first()
    assert (empty["resolved"], empty["pending"], empty["queue_precision"]) == (0, 5, 0.0)
