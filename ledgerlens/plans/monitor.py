"""Monitoring queries (MN1-MN9): drift, rolling performance, triggers, summary."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import one_row, round_doubles
from ..operators import evaluate as M
from ..operators import features as FE
from ..operators import monitor as MN
from ..operators import prep as P
from ..sources.fixture import transactions
from .evaluate import BEST_CTE, CONF_SQL, test_threshold
from .features import matrix_cte
from .registry import query, txn_sql

MONITOR_FEATURES = FE.BEHAVIOURAL_BASE + [f"{p}_{c}" for p in ("home", "ip") for c in FE.SORTED_COUNTRIES]


def monitoring_frame(spark, sf):
    """MN1: rebuild features over the universe and score them at the policy threshold."""
    te, t = test_threshold(spark, sf)
    feats = FE.build_features(transactions(spark, sf))
    mf = feats.select("txn_id", *MONITOR_FEATURES, F.col("isFraud").alias("target"),
                      (F.col("score") >= F.lit(t)).cast("int").alias("prediction"),
                      F.col("score").alias("prediction_proba"), "amount_raw")
    return mf, te, t


def split(spark, sf):
    mf, te, t = monitoring_frame(spark, sf)
    ref, cur = P.reference_current(mf, S.REFERENCE_MAX_STEP, "step")
    return ref, cur, te, t


# ---- DuckDB pieces -------------------------------------------------------------

def _erfc_sql(x: str) -> str:
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    t = f"(1.0 / (1.0 + 0.5 * abs({x})))"
    poly = f"{coeffs[-1]}"
    for c in reversed(coeffs[:-1]):
        poly = f"({c} + {t} * {poly})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def _ks_p_sql(d: str, n: str, m: str) -> str:
    ne = f"round({n} * {m} / ({n} + {m}))"
    lam = f"((sqrt({ne}) + 0.12 + 0.11 / sqrt({ne})) * {d})"
    small = " + ".join(f"exp(-{float((2 * k - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({lam} * {lam}))" for k in range(1, 9))
    big = " + ".join(f"{float((-1) ** (k - 1))!r} * exp({-2.0 * k * k!r} * {lam} * {lam})" for k in range(1, 9))
    q = (f"CASE WHEN {lam} <= 0 THEN 1.0 WHEN {lam} < 1.18 THEN 1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * ({small}) "
         f"ELSE 2.0 * ({big}) END")
    return f"least(greatest({q}, 0.0), 1.0)"


def _chi2_sql() -> str:
    o = ["ref0", "ref1", "cur0", "cur1"]
    rows = ["(ref0 + ref1)", "(ref0 + ref1)", "(cur0 + cur1)", "(cur0 + cur1)"]
    cols = ["(ref0 + cur0)", "(ref1 + cur1)", "(ref0 + cur0)", "(ref1 + cur1)"]
    n = "(ref0 + ref1 + cur0 + cur1)"
    terms = []
    for obs, r, c in zip(o, rows, cols):
        e = f"({r} * {c} / {n})"
        adj = f"({obs} + sign({e} - {obs}) * least(0.5, abs({e} - {obs})))"
        terms.append(f"(({adj} - {e}) * ({adj} - {e}) / {e})")
    ok = " AND ".join(f"{r} * {c} > 0" for r, c in zip(rows, cols))
    return f"CASE WHEN {ok} THEN {' + '.join(terms)} END"


MON_BASE = BEST_CTE + ",\n" + matrix_cte() + """,
mf AS (SELECT fm.*, fm.isFraud AS target, CAST(t.score >= (SELECT threshold FROM best) AS INTEGER) AS prediction,
              t.score AS prediction_proba FROM fm JOIN transactions t USING (txn_id)),
mref AS (SELECT * FROM mf WHERE step <= 354),
mcur AS (SELECT * FROM mf WHERE step > 354)"""


def _drift_ctes(base: str = MON_BASE, cur: str = "mcur") -> str:
    lng = " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {src}"
        for side, src in (("ref", "mref"), ("cur", cur)) for f in MONITOR_FEATURES)
    return base + f""",
lng AS (SELECT * FROM ({lng}) WHERE value IS NOT NULL AND NOT isnan(value)),
fst AS (SELECT feature, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS n_ref, sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS n_cur,
               avg(CASE WHEN side = 'ref' THEN value END) AS reference_mean, avg(CASE WHEN side = 'cur' THEN value END) AS current_mean,
               sum(CASE WHEN side = 'ref' AND value = 0 THEN 1 ELSE 0 END) AS ref0, sum(CASE WHEN side = 'ref' AND value = 1 THEN 1 ELSE 0 END) AS ref1,
               sum(CASE WHEN side = 'cur' AND value = 0 THEN 1 ELSE 0 END) AS cur0, sum(CASE WHEN side = 'cur' AND value = 1 THEN 1 ELSE 0 END) AS cur1,
               sum(CASE WHEN value NOT IN (0, 1) THEN 1 ELSE 0 END) = 0 AS is_binary
        FROM lng GROUP BY feature),
chi AS (SELECT feature, 'chi2_binary' AS method, abs(current_mean - reference_mean) AS score, {_chi2_sql()} AS statistic,
               reference_mean, current_mean FROM fst WHERE is_binary AND n_ref > 0 AND n_cur > 0),
chip AS (SELECT *, CASE WHEN statistic IS NULL THEN 1.0 ELSE {_erfc_sql('sqrt(statistic / 2.0)')} END AS p_value FROM chi),
kc AS (SELECT l.feature, value, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS c_ref, sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS c_cur
       FROM lng l JOIN fst f ON l.feature = f.feature AND NOT f.is_binary AND f.n_ref > 0 AND f.n_cur > 0 GROUP BY l.feature, value),
kd AS (SELECT k.feature, max(abs(cr / f.n_ref - cc / f.n_cur)) AS D, any_value(f.n_ref) AS n_ref, any_value(f.n_cur) AS n_cur,
              any_value(f.reference_mean) AS reference_mean, any_value(f.current_mean) AS current_mean
       FROM (SELECT *, sum(c_ref) OVER (PARTITION BY feature ORDER BY value) AS cr, sum(c_cur) OVER (PARTITION BY feature ORDER BY value) AS cc FROM kc) k
       JOIN fst f USING (feature) GROUP BY k.feature),
ks AS (SELECT feature, 'ks_numeric' AS method, D AS score, D AS statistic,
              {_ks_p_sql('D', 'CAST(n_ref AS DOUBLE)', 'CAST(n_cur AS DOUBLE)')} AS p_value, reference_mean, current_mean FROM kd),
drift AS (SELECT feature, method, score, statistic, p_value, reference_mean, current_mean, p_value < 0.05 AS drifted FROM chip
          UNION ALL SELECT feature, method, score, statistic, p_value, reference_mean, current_mean, p_value < 0.05 FROM ks)"""


DRIFT_COLS = "feature, method, round(score, 6) AS score, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean, drifted"


@query("monitoring_frame", txn_sql("SELECT txn_id, step, target, prediction, prediction_proba, round(amount_raw, 6) AS amount_raw FROM mf",
                                   ctes=MON_BASE))
def monitoring_frame_q(spark, sf):
    """MN1: historical universe rebuilt into features and scored at the policy threshold."""
    mf, _, _ = monitoring_frame(spark, sf)
    return round_doubles(mf.select("txn_id", "step", "target", "prediction", "prediction_proba", "amount_raw"))


@query("drift_chi2", txn_sql(f"SELECT {DRIFT_COLS} FROM drift WHERE method = 'chi2_binary'", ctes=_drift_ctes()))
def drift_chi2(spark, sf):
    """MN3/MN4a: binary-feature detection and Yates chi-square drift (p from erfc)."""
    ref, cur, _, _ = split(spark, sf)
    return round_doubles(MN.drift_chi2(MN.feature_stats(ref, cur, MONITOR_FEATURES)))


@query("drift_ks", txn_sql(f"SELECT {DRIFT_COLS} FROM drift WHERE method = 'ks_numeric'", ctes=_drift_ctes()))
def drift_ks(spark, sf):
    """MN4b: two-sample KS drift (D from distributed running sums, asymptotic p)."""
    ref, cur, _, _ = split(spark, sf)
    return round_doubles(MN.drift_ks(ref, cur, MONITOR_FEATURES))


@query("drift_summary", txn_sql(f"SELECT {DRIFT_COLS} FROM drift", ctes=_drift_ctes()))
def drift_summary(spark, sf):
    """MN4c: drift table over the 37 deployed features (drifted = p < 0.05)."""
    ref, cur, _, _ = split(spark, sf)
    return round_doubles(MN.drift_summary(ref, cur, MONITOR_FEATURES))


@query("drift_top10", txn_sql(f"SELECT {DRIFT_COLS} FROM drift ORDER BY drifted DESC, round(score, 6) DESC, feature LIMIT 10",
                              ctes=_drift_ctes()))
def drift_top10(spark, sf):
    """MN8: the ten most drifted features (a top-k report)."""
    ref, cur, _, _ = split(spark, sf)
    d = round_doubles(MN.drift_summary(ref, cur, MONITOR_FEATURES))
    return d.orderBy(F.col("drifted").desc(), F.col("score").desc(), "feature").limit(10)


ROLL_CTE_T = """,
per AS (SELECT step, count(*) AS n, sum(target) AS fraud, sum(prediction) AS flagged,
               sum(CASE WHEN target = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp FROM {cur} WHERE target IS NOT NULL GROUP BY step),
win AS (SELECT step, sum(n) OVER w AS n, sum(fraud) OVER w AS fraud, sum(flagged) OVER w AS flagged, sum(tp) OVER w AS tp
        FROM per WINDOW w AS (ORDER BY step RANGE BETWEEN 167 PRECEDING AND CURRENT ROW)),
roll AS (SELECT step - 167 AS window_start_step, step AS window_end_step, CAST(n AS BIGINT) AS n_transactions, CAST(fraud AS BIGINT) AS n_fraud,
                CAST(flagged AS BIGINT) AS n_flagged, prec AS precision, rec AS recall,
                CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END AS f1, fraud / n AS fraud_rate
         FROM (SELECT *, CASE WHEN flagged > 0 THEN tp / flagged ELSE 0.0 END AS prec, CASE WHEN fraud > 0 THEN tp / fraud ELSE 0.0 END AS rec FROM win))"""
ROLL_CTE = ROLL_CTE_T.format(cur="mcur")



@query("rolling_metrics", txn_sql("""
SELECT window_start_step, window_end_step, n_transactions, n_fraud, n_flagged, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(fraud_rate, 6) AS fraud_rate FROM roll""", ctes=MON_BASE + ROLL_CTE))
def rolling_metrics(spark, sf):
    """MN5: 168-step rolling precision / recall / F1 / fraud rate per labelled current step."""
    _, cur, _, _ = split(spark, sf)
    return round_doubles(MN.rolling_metrics(cur))


@query("rolling_ap", txn_sql("""
SELECT window_end_step, round(CASE WHEN P > 0 AND N > 0 THEN ap END, 6) AS average_precision FROM (
  SELECT window_end_step, sum(n_pos / P * cp / (cp + cn)) AS ap, any_value(P) AS P, any_value(N) AS N FROM (
    SELECT *, sum(n_pos) OVER (PARTITION BY window_end_step ORDER BY s DESC) AS cp, sum(n_neg) OVER (PARTITION BY window_end_step ORDER BY s DESC) AS cn,
           sum(n_pos) OVER (PARTITION BY window_end_step) AS P, sum(n_neg) OVER (PARTITION BY window_end_step) AS N
    FROM (SELECT e.window_end_step, c.s, sum(c.n_pos) AS n_pos, sum(c.n_neg) AS n_neg
          FROM (SELECT step, prediction_proba AS s, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN target <> 1 THEN 1 ELSE 0 END) AS n_neg
                FROM mcur WHERE target IS NOT NULL AND prediction_proba IS NOT NULL GROUP BY ALL) c
          JOIN (SELECT DISTINCT step AS window_end_step FROM mcur WHERE target IS NOT NULL AND prediction_proba IS NOT NULL) e
            ON e.window_end_step BETWEEN c.step AND c.step + 167
          GROUP BY ALL))
  GROUP BY window_end_step)""", ctes=MON_BASE))
def rolling_ap(spark, sf):
    """MN6/J3: rolling average precision per window end (range membership of steps in windows; NULL for a one-class window)."""
    _, cur, _, _ = split(spark, sf)
    r = MN.rolling_average_precision(cur)
    return r.select("window_end_step", F.round("average_precision", 6).alias("average_precision"))


@query("labelled_screen", txn_sql("""
SELECT count(*) AS rows, count(target) AS labelled_rows, CAST(coalesce(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_fraud,
       CAST(coalesce(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_legit,
       coalesce(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END), 0) > 0 AND coalesce(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END), 0) > 0 AS classes_sufficient
FROM mcur""", ctes=MON_BASE))
def labelled_screen(spark, sf):
    """MN9: labelled rows in the current window and whether both classes are present."""
    _, cur, _, _ = split(spark, sf)
    return MN.labelled_screen(cur)


def _baseline(te, t):
    row = M.confusion(te, t).select("test_precision", "test_recall").first()
    return float(row["test_precision"]), float(row["test_recall"])


@query("triggers", txn_sql("""
SELECT round(df, 6) AS drift_fraction, 0.3::DOUBLE AS drift_threshold, df > 0.3 AS drift_breached,
       round(lp, 6) AS latest_precision, round(bp * 0.7, 6) AS precision_threshold, coalesce(hp AND lp < bp * 0.7, false) AS precision_breached,
       round(lr, 6) AS latest_recall, round(br - 0.15, 6) AS recall_threshold, coalesce(hp AND lr < br - 0.15, false) AS recall_breached,
       hp AS has_labelled_performance,
       df > 0.3 OR coalesce(hp AND lp < bp * 0.7, false) OR coalesce(hp AND lr < br - 0.15, false) AS should_retrain
FROM (SELECT (SELECT coalesce(avg(CAST(drifted AS DOUBLE)), 0.0) FROM drift) AS df,
             (SELECT precision FROM roll ORDER BY window_end_step DESC LIMIT 1) AS lp,
             (SELECT recall FROM roll ORDER BY window_end_step DESC LIMIT 1) AS lr,
             (SELECT count(*) > 0 FROM roll) AS hp,
             (SELECT test_precision FROM baseline) AS bp, (SELECT test_recall FROM baseline) AS br)""",
    ctes=_drift_ctes() + ROLL_CTE + f",\nbaseline AS ({CONF_SQL})"))
def triggers(spark, sf):
    """MN7: retraining triggers against the policy's test precision / recall."""
    ref, cur, te, t = split(spark, sf)
    bp, br = _baseline(te, t)
    drift = MN.drift_summary(ref, cur, MONITOR_FEATURES)
    out = MN.triggers(drift, MN.rolling_metrics(cur), bp, br)
    return round_doubles(out)


@query("monitor_summary", txn_sql("""
SELECT (SELECT count(*) FROM mref) AS reference_rows, (SELECT count(*) FROM mcur) AS current_rows,
       (SELECT count(*) FROM drift) AS features_checked, (SELECT CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) FROM drift) AS drifted_features,
       (SELECT max(window_end_step) FROM roll) AS latest_window_end_step,
       (SELECT round(precision, 6) FROM roll ORDER BY window_end_step DESC LIMIT 1) AS latest_precision,
       (SELECT round(recall, 6) FROM roll ORDER BY window_end_step DESC LIMIT 1) AS latest_recall""", ctes=_drift_ctes() + ROLL_CTE))
def monitor_summary(spark, sf):
    """MN8: split sizes, drifted-feature count and the latest rolling window."""
    ref, cur, _, _ = split(spark, sf)
    drift = MN.drift_summary(ref, cur, MONITOR_FEATURES)
    roll = MN.rolling_metrics(cur)
    a = ref.agg(F.count(F.lit(1)).alias("reference_rows"))
    b = cur.agg(F.count(F.lit(1)).alias("current_rows"))
    c = drift.agg(F.count(F.lit(1)).alias("features_checked"), F.sum(F.col("drifted").cast("int")).cast("long").alias("drifted_features"))
    d = roll.agg(F.max("window_end_step").alias("latest_window_end_step"),
                 F.max_by(F.struct("precision", "recall"), F.col("window_end_step")).alias("l"))
    return one_row(a, b, c, d).select(
        "reference_rows", "current_rows", "features_checked", "drifted_features", "latest_window_end_step",
        F.round("l.precision", 6).alias("latest_precision"), F.round("l.recall", 6).alias("latest_recall"))


# ---- current set from the scored-event log (MN2) ----------------------------------

def event_features(spark, sf):
    """MN2: parsed, defaulted log events rebuilt into the deployed features (velocity over events)."""
    from ..sources import events as EV
    from .score import event_lines

    ev = EV.event_frame(EV.good_events(EV.parse_lines(event_lines(spark, sf))))
    f = FE.causal_velocity(ev, "nameDest", "dest", id_col="transaction_id")
    f = FE.one_hot(FE.row_features(f))
    return f.select("transaction_id", *MONITOR_FEATURES, F.col("isFraud").alias("target"), "prediction",
                    "prediction_proba", F.col("amount").alias("amount_raw"))


def _event_base() -> str:
    """DuckDB: historical monitoring CTEs + scored rows + the event current set `ecur`."""
    from ..sources.events import stand_in_sql
    from .features import ONE_HOT_SQL, ROW_SQL
    from .score import SCORED_CTE

    assert SCORED_CTE.startswith(BEST_CTE)
    r = stand_in_sql("")
    w = "(PARTITION BY nameDest ORDER BY step, transaction_id)"
    row = ", ".join(f"{v} AS {k}" for k, v in ROW_SQL.items() if k in MONITOR_FEATURES)
    hot = ", ".join(f"{v} AS {k}" for k, v in ONE_HOT_SQL.items())
    return MON_BASE + SCORED_CTE[len(BEST_CTE):] + f""",
evd AS (
  SELECT 'txn_' || CAST(txn_id AS VARCHAR) AS transaction_id, type,
         CAST(CASE WHEN {r['opt_off']} THEN 744 ELSE step END AS BIGINT) AS step,
         CAST(CASE WHEN {r['opt_off']} THEN 744 % 24 ELSE hour_of_day END AS INTEGER) AS hour_of_day,
         CAST(CASE WHEN {r['opt_off']} THEN 744 % 24 ELSE hour_of_day END BETWEEN 0 AND 5 AS INTEGER) AS is_night,
         CASE WHEN {r['opt_off']} THEN 'UNKNOWN_DEST' ELSE nameDest END AS nameDest,
         amount, account_age_days, failed_payment_attempts, ip_billing_distance_km, is_new_device, shipping_billing_mismatch,
         home_billing_country, ip_country, CASE WHEN {r['no_label']} THEN CAST(isFraud AS DOUBLE) END AS target,
         fraud_probability AS prediction_proba, CAST(decision IN ('REVIEW', 'BLOCK') AS INTEGER) AS prediction
  FROM sc WHERE type IN ('TRANSFER','CASH_OUT') AND NOT ({r['blank']}) AND NOT ({r['junk']})),
ecur AS (
  SELECT *, {row}, {hot},
         row_number() OVER {w} - 1 AS dest_prior_count,
         coalesce(CAST(step - lag(step) OVER {w} AS DOUBLE), -1.0) AS dest_steps_since_last,
         CAST(lag(step) OVER {w} IS NULL AS INTEGER) AS dest_first_seen
  FROM evd)"""



@query("event_drift", txn_sql(f"SELECT {DRIFT_COLS} FROM drift", ctes=_drift_ctes(_event_base(), "ecur")))
def event_drift(spark, sf):
    """MN2 + MN4: drift of the 37 deployed features, historical reference (step <= 354) vs events rebuilt from the log."""
    ref, _, _, _ = split(spark, sf)
    return round_doubles(MN.drift_summary(ref, event_features(spark, sf), MONITOR_FEATURES))


@query("event_rolling", txn_sql("""
SELECT window_start_step, window_end_step, n_transactions, n_fraud, n_flagged, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(fraud_rate, 6) AS fraud_rate FROM roll""",
    ctes=_event_base() + ROLL_CTE_T.format(cur="ecur")))
def event_rolling(spark, sf):
    """MN2 + MN5: rolling metrics over the labelled events of the log (logged decisions as predictions)."""
    return round_doubles(MN.rolling_metrics(event_features(spark, sf)))


# ---- the deployed model in monitoring (MN1, MN2) -----------------------------------

@query("monitoring_model")
def monitoring_model(spark, sf):
    """MN1/T7/M5: features rebuilt over the whole history, scaled and scored by the saved model, flagged at its policy threshold."""
    from ..operators import score as SC
    from .ml import _saved_parts

    model, stats, policy = _saved_parts(spark, sf)
    feats = FE.build_features(transactions(spark, sf))
    x = SC.model_probability(feats, model, stats, "prediction_proba")
    return x.select("txn_id", F.col("step_raw").alias("step"), F.col("isFraud").alias("target"), "prediction_proba",
                    (F.col("prediction_proba") >= F.lit(float(policy["threshold"]))).cast("int").alias("prediction"), "amount_raw")


@query("event_scored")
def event_scored(spark, sf):
    """MN2/M5: log events rebuilt into features; those without a logged probability (one in four) are scored by the saved model."""
    from ..operators import score as SC
    from .ml import _saved_parts

    model, stats, policy = _saved_parts(spark, sf)
    ev = event_features(spark, sf)
    lost = F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == 0
    ev = ev.withColumn("was_logged", ~lost).withColumn("prediction_proba", F.when(~lost, F.col("prediction_proba")))
    out = SC.fill_scores(ev, model, stats, float(policy["threshold"]))
    return out.select("transaction_id", "prediction_proba", "prediction", "target", "was_logged")
