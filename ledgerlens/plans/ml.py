"""Spark ML queries (M1-M5, M14-M16, M22-M24, T12, T16, S9, S10): rows-only checks.

Training frames are the robust-scaled behavioural features of the temporal
train fold; validation is its last 15 % by step. Frames that iterative
learners re-read are persisted for the duration of a query's fits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import one_row
from ..operators import evaluate as M
from ..operators import features as FE
from ..operators import prep as P
from ..operators import train as TR
from ..operators import tuning as TU
from ..operators.smote import smote
from ..session import checkpoint_dir, ensure_checkpoint_dir
from ..sources.fixture import transactions
from .registry import query, txn_sql

BEHAVIOURAL = FE.BEHAVIOURAL_BASE + [f"{p}_{c}" for p in ("home", "ip") for c in FE.SORTED_COUNTRIES]


def model_frames(spark, sf):
    """Scaled train fold, its inner train / validation split, the test fold, the feature list."""
    m = FE.feature_matrix(transactions(spark, sf))[0]
    tr, te, _ = P.temporal_split(m, 0.8, "step_raw")
    cont = [c for c in S.CONTINUOUS_FEATURES if c in m.columns]
    stats = P.stats_dict(P.robust_stats(tr, cont), "center", "scale")
    # the scaled train fold feeds every fit: checkpoint it to the shared folder (cuts lineage)
    ensure_checkpoint_dir(spark)
    tr_s = P.apply_scaler(tr, stats).checkpoint(eager=True)
    te_s = P.apply_scaler(te, stats)
    itr, iva, _ = P.inner_split(tr_s)
    return tr_s, te_s, itr, iva, BEHAVIOURAL


def _scored_validation(spark, sf, model_name, params, method):
    tr, _, itr, iva, feats = model_frames(spark, sf)
    bal = TR.resampled(itr, method, feats)
    model = TR.fit(bal, feats, model_name, params, method)
    return TR.predict_proba(model, iva.select("txn_id", *feats, "isFraud")).select("txn_id", "isFraud", "proba")


@query("train_lr")
def train_lr(spark, sf):
    """M1/M5: class-weighted logistic regression (C = 1) scored on validation."""
    return _scored_validation(spark, sf, "LogisticRegression", {"C": 1.0}, "class_weighted")


@query("train_rf")
def train_rf(spark, sf):
    """M2/M5: random forest (50 trees, depth 8, leaf 100, sqrt features) scored on validation."""
    return _scored_validation(spark, sf, "RandomForest", TR.RF_CONFIGS[0], "original")


@query("train_gbt")
def train_gbt(spark, sf):
    """M3/M5: gradient-boosted trees (100 iterations) on the 0.05-undersampled inner train, scored on validation."""
    return _scored_validation(spark, sf, "GBT", TR.GBT_CONFIGS[0], "undersampling")


def _smote_sql() -> str:
    from .prep import _INNER

    return txn_sql("""
SELECT isFraud, 0 AS synthetic, count(*) AS rows FROM itr GROUP BY isFraud
UNION ALL
SELECT 1, 1, CAST(floor(0.05 * sum(1 - isFraud)) AS BIGINT) - CAST(sum(isFraud) AS BIGINT) FROM itr
HAVING floor(0.05 * sum(1 - isFraud)) > sum(isFraud)""", ctes=_INNER)


@query("smote", _smote_sql())
def smote_q(spark, sf):
    """SMOTE (k = 5, ratio 0.05) of the inner train split: rows per class and origin."""
    _, _, itr, _, feats = model_frames(spark, sf)
    out = smote(itr, feats, ratio=TR.SMOTE_TARGET_RATIO)
    return out.groupBy("isFraud", "synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query("rf_importance")
def rf_importance(spark, sf):
    """Random-forest importance ranking of the columns that T14 and T15 leave of the scaled train fold."""
    tr, _, _, _, _ = model_frames(spark, sf)
    every = FE.candidate_features(tr.drop("amount_raw", "step_raw"))
    varied = [r["feature"] for r in P.variance_filter(tr, every).where(~F.col("dropped")).orderBy("idx").collect()]
    kept = [c for c, _, redundant in P.correlation_prune(tr, varied) if not redundant]
    return TR.feature_importance(tr, kept).orderBy(F.col("importance").desc())


def tuning_results(spark, sf, models=tuple(TR.MODEL_NAMES)):
    """The tuning table of some families; fits that the folder of these frames holds are read back."""
    _, _, itr, iva, feats = model_frames(spark, sf)
    return TU.tune(itr, iva, feats, models=list(models))


@query("tune_lr")
def tune_lr(spark, sf):
    """M4: the logistic-regression part of the grid (5 C values x 4 balancing methods = 20 fits)."""
    return tuning_results(spark, sf, models=("LogisticRegression",))


@query("tune_rf")
def tune_rf(spark, sf):
    """M4: the random-forest part of the grid (8 configurations x 4 balancing methods = 32 fits)."""
    return tuning_results(spark, sf, models=("RandomForest",))


@query("tune_gbt")
def tune_gbt(spark, sf):
    """M4: the boosted-tree part of the grid (8 configurations x 4 balancing methods = 32 fits)."""
    return tuning_results(spark, sf, models=("GBT",))


@query("leaderboard")
def leaderboard(spark, sf):
    """Best config per (balancing, model) of all 84 fits, winner flagged, ranked by net cost."""
    res = tuning_results(spark, sf)
    return TR.leaderboard(TR.overall_winner(res), "val_net_cost")


@query("leaderboard_auc_pr")
def leaderboard_auc_pr(spark, sf):
    """All 84 fits ranked by validation AUC-PR."""
    return TR.leaderboard(tuning_results(spark, sf), "val_auc_pr")


def _winner(spark, sf):
    res = tuning_results(spark, sf)
    w = TR.overall_winner(res).where("selected").first()
    import json

    return w["data_balancing"], w["model"], json.loads(w["params_json"]), float(w["val_threshold"])


@query("final_test")
def final_test(spark, sf):
    """Refit the validation winner on the whole train fold; evaluate once on test at the frozen threshold."""
    return _final_test(spark, sf, _winner(spark, sf))


def _final_test(spark, sf, winner):
    method, model_name, params, t = winner
    tr, te, _, _, feats = model_frames(spark, sf)
    model = TR.fit(TR.resampled(tr, method, feats), feats, model_name, params, method)
    scored = TR.predict_proba(model, te.select("txn_id", *feats, "isFraud", "amount_raw"))
    ap = M.average_precision(scored, "proba").select(F.col("average_precision").alias("test_auc_pr"))
    conf = M.confusion(scored, t, "proba")
    return one_row(conf, ap).select(
        F.lit(model_name).alias("model"), F.lit(method).alias("data_balancing"), "*")


@query("policy_document")
def policy_document(spark, sf):
    """Persist the policy (threshold, features, cost model, test metrics) and read it back."""
    winner = _winner(spark, sf)
    method, model_name, _, t = winner
    metrics = _final_test(spark, sf, winner).first().asDict()
    doc = TR.policy_document(t, BEHAVIOURAL, metrics, model_name, method)
    path = f"{checkpoint_dir(spark).rstrip('/')}/policy-{uuid.uuid4().hex}"
    TR.write_policy(spark, doc, path)
    return TR.read_policy(spark, path)


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Save a fitted pipeline, load it back, and compare its validation probabilities."""
    tr, _, itr, iva, feats = model_frames(spark, sf)
    model = TR.fit(itr, feats, "LogisticRegression", {"C": 1.0}, "original")
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    TR.save_model(model, path)
    again = TR.load_model(path)
    v = iva.select("txn_id", *feats, "isFraud")
    a = TR.predict_proba(model, v, "p1").select("txn_id", "p1")
    b = TR.predict_proba(again, v, "p2").select("txn_id", "p2")
    return a.join(b, "txn_id").select("txn_id", "p1", "p2", (F.abs(F.col("p1") - F.col("p2"))).alias("abs_diff"))


@query("feature_list_document")
def feature_list_document(spark, sf):
    """FE25/S9: feature-list document (features, label, train-fold class weights, scaled and audit columns) written and read back."""
    import json

    m, feats = FE.feature_matrix(transactions(spark, sf))
    tr, _, _ = P.temporal_split(m, 0.8, "step_raw")
    weights = {int(r["isFraud"]): float(r["weight"]) for r in P.class_weights(tr).collect()}
    doc = {"features": feats, "label": S.LABEL, "class_weight": {str(k): v for k, v in sorted(weights.items())},
           "scaled_columns": [c for c in S.CONTINUOUS_FEATURES if c in feats], "audit_columns": ["amount_raw", "step_raw"]}
    path = f"{checkpoint_dir(spark).rstrip('/')}/feature-list-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return TR.read_policy(spark, path)


@query("feature_usage")
def feature_usage(spark, sf):
    """M23/FE23/FE25: every candidate feature: whether the behavioural model uses it and why, and its range over the matrix."""
    m, feats = FE.feature_matrix(transactions(spark, sf))
    used = FE.behavioural(feats)
    row = m.agg(*[F.struct(F.min(F.col(f).cast("double")).alias("low"), F.max(F.col(f).cast("double")).alias("high"), F.count(f).alias("n")).alias(f) for f in feats])
    of = lambda f: F.struct(
        F.lit(f).alias("feature"), F.lit(f in used).alias("used_for_training"),
        F.lit("behavioural/contextual" if f in used else "removed mechanical balance/amount signal").alias("reason"), F.col(f).alias("s"))
    return row.select(F.explode(F.array(*[of(f) for f in feats])).alias("x")).select("x.feature", "x.used_for_training", "x.reason", "x.s.low", "x.s.high", "x.s.n")


def _saved_parts(spark, sf):
    """A logistic model fitted on the train fold, and its scaler statistics, both saved and loaded back."""
    import json

    m = FE.feature_matrix(transactions(spark, sf))[0]
    tr, _, _ = P.temporal_split(m, 0.8, "step_raw")
    stats = P.stats_dict(P.robust_stats(tr, [c for c in S.CONTINUOUS_FEATURES if c in m.columns]), "center", "scale")
    model = TR.fit(P.apply_scaler(tr, stats), BEHAVIOURAL, "LogisticRegression", {"C": 1.0}, "original")
    root = f"{checkpoint_dir(spark).rstrip('/')}/scorer-{uuid.uuid4().hex}"
    TR.save_model(model, f"{root}/model")
    TR.write_policy(spark, {"scaler": {k: list(v) for k, v in stats.items()}, "threshold": 0.05, "model": "logistic"}, f"{root}/policy")
    doc = json.loads(spark.read.text(f"{root}/policy").first()[0])
    return TR.load_model(f"{root}/model"), {k: tuple(v) for k, v in doc["scaler"].items()}, doc


@query("model_scored")
def model_scored(spark, sf):
    """Requests scored by a saved model with saved scaler statistics and policy."""
    from ..operators import score as SC

    model, stats, policy = _saved_parts(spark, sf)
    out = SC.score_with_model(transactions(spark, sf), model, stats, policy)
    return out.select("txn_id", "decision", "fraud_probability", "dest_prior_count", "dest_steps_since_last")
