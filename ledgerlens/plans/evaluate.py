"""Evaluation and threshold-policy queries (M6-M21, A26) on the deterministic `score`.

Validation = the inner 15 % (by step) of the 80 % train fold; test = the last
20 % by step. The threshold is chosen on validation and applied once on test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import evaluate as M
from ..operators import prep as P
from ..sources.fixture import transactions
from .registry import query, txn_sql


def eval_frame(spark, sf):
    t = transactions(spark, sf).where(F.col("type").isin(S.FRAUD_TYPES))
    return t.select("txn_id", F.col("step").alias("step_raw"), "type", "isFraud", F.col("amount").alias("amount_raw"), "score")


def folds(spark, sf):
    ev = eval_frame(spark, sf)
    tr, te, _ = P.temporal_split(ev, 0.8, "step_raw")
    itr, iva, _ = P.inner_split(tr)
    return tr, te, itr, iva


EV_CTE = """ev AS (SELECT txn_id, step AS step_raw, type, isFraud, amount AS amount_raw, score FROM transactions WHERE type IN ('TRANSFER','CASH_OUT')),
cut AS (SELECT quantile_cont(step_raw, 0.8) AS c FROM ev),
etr AS (SELECT ev.* FROM ev, cut WHERE step_raw <= cut.c),
ete AS (SELECT ev.* FROM ev, cut WHERE step_raw > cut.c),
icut AS (SELECT quantile_cont(step_raw, 0.85) AS c FROM etr),
iva AS (SELECT etr.* FROM etr, icut WHERE step_raw > icut.c),
grid AS (SELECT CAST(i AS DOUBLE) / 2000.0::DOUBLE AS threshold FROM range(1, 101) t(i)
         UNION ALL SELECT CAST(i AS DOUBLE) / 200.0::DOUBLE FROM range(11, 201) t(i))"""


def _sweep_sql(src: str, c_fp: str = "10.0") -> str:
    return f"""SELECT threshold,
       round(sum(CASE WHEN isFraud = 1 AND score < threshold THEN amount_raw ELSE 0.0 END) + {c_fp} * sum(CASE WHEN isFraud = 0 AND score >= threshold THEN 1 ELSE 0 END), 6) AS net_cost,
       round(sum(CASE WHEN isFraud = 1 AND score < threshold THEN amount_raw ELSE 0.0 END), 6) AS missed_fraud_amount,
       round(sum(CASE WHEN isFraud = 1 AND score >= threshold THEN amount_raw ELSE 0.0 END), 6) AS fraud_amount_caught,
       CAST(sum(CASE WHEN isFraud = 0 AND score >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_fp,
       CAST(sum(CASE WHEN isFraud = 1 AND score >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_tp,
       CAST(sum(CASE WHEN isFraud = 1 AND score < threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_fn
FROM grid, {src} GROUP BY threshold"""


SWEEP_CTE = EV_CTE + f",\nsweep AS ({_sweep_sql('iva')})"
BEST_CTE = SWEEP_CTE + """,
best AS (SELECT * FROM sweep WHERE threshold >= 0.0005 AND n_fp + n_tp < (SELECT count(*) FROM iva)
         ORDER BY net_cost, n_fp, threshold LIMIT 1)"""


@query("threshold_sweep", txn_sql("SELECT * FROM sweep", ctes=SWEEP_CTE))
def threshold_sweep(spark, sf):
    """M6/M7: net cost over the 290-threshold grid on validation (binned, one aggregate)."""
    _, _, _, iva = folds(spark, sf)
    return M.threshold_sweep(iva)


@query("best_threshold", txn_sql("SELECT * FROM best", ctes=BEST_CTE))
def best_threshold(spark, sf):
    """M8: admissible minimum-net-cost threshold on validation."""
    _, _, _, iva = folds(spark, sf)
    return M.best_threshold(M.threshold_sweep(iva), iva.count())


AP_SQL = """SELECT round(CASE WHEN sum(n_pos) > 0 THEN sum(n_pos / P * cp / (cp + cn)) END, 6) AS average_precision,
       CAST(sum(n_pos) AS BIGINT) AS n_pos, CAST(sum(n_neg) AS BIGINT) AS n_neg
FROM (SELECT *, sum(n_pos) OVER (ORDER BY s DESC) AS cp, sum(n_neg) OVER (ORDER BY s DESC) AS cn,
             sum(n_pos) OVER () AS P
      FROM (SELECT score AS s, sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN isFraud = 1 THEN 0 ELSE 1 END) AS n_neg
            FROM {src} WHERE score IS NOT NULL GROUP BY score))"""


@query("average_precision", txn_sql(AP_SQL.format(src="ete"), ctes=EV_CTE))
def average_precision(spark, sf):
    """M9: step-wise average precision on the test fold."""
    _, te, _, _ = folds(spark, sf)
    a = M.average_precision(te)
    return a.select(F.round("average_precision", 6).alias("average_precision"), "n_pos", "n_neg")


@query("roc_auc", txn_sql("""
SELECT round(CASE WHEN sum(n_pos) > 0 AND sum(n_neg) > 0 THEN sum(n_pos * (below + 0.5 * n_neg)) / (sum(n_pos) * sum(n_neg)) END, 6) AS roc_auc
FROM (SELECT *, coalesce(sum(n_neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score AS s, sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN isFraud = 1 THEN 0 ELSE 1 END) AS n_neg
            FROM ete WHERE score IS NOT NULL GROUP BY score))""", ctes=EV_CTE))
def roc_auc(spark, sf):
    """ROC-AUC (mid-rank Mann-Whitney) on the test fold."""
    _, te, _, _ = folds(spark, sf)
    return M.roc_auc(te).select(F.round("roc_auc", 6).alias("roc_auc"))


CONF_SQL = """SELECT t AS threshold, test_rows, test_fraud_rows, round(test_fraud_rows / test_rows * 100.0, 6) AS test_prevalence_pct,
       round(prec, 6) AS test_precision, round(rec, 6) AS test_recall,
       round(CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS test_f1,
       tp AS test_tp, fn AS test_fn, fp AS test_fp, tn AS test_tn, tp + fp AS test_review_queue,
       round((tp + fp) / test_rows * 100.0, 6) AS test_review_rate_pct,
       round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END, 6) AS test_fpr,
       round(caught, 6) AS test_fraud_amount_caught, round(missed, 6) AS test_fraud_amount_missed,
       10.0::DOUBLE AS c_fp_assumption, round(missed + 10.0 * fp, 6) AS test_net_cost
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec
      FROM (SELECT (SELECT threshold FROM best) AS t, count(*) AS test_rows, CAST(sum(isFraud) AS BIGINT) AS test_fraud_rows,
                   CAST(sum(CASE WHEN isFraud = 1 AND score >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                   CAST(sum(CASE WHEN isFraud = 1 AND score < (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS fn,
                   CAST(sum(CASE WHEN isFraud = 0 AND score >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                   CAST(sum(CASE WHEN isFraud = 0 AND score < (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS tn,
                   coalesce(sum(CASE WHEN isFraud = 1 AND score >= (SELECT threshold FROM best) THEN amount_raw END), 0.0) AS caught,
                   coalesce(sum(CASE WHEN isFraud = 1 AND score < (SELECT threshold FROM best) THEN amount_raw END), 0.0) AS missed
            FROM ete))"""


def test_threshold(spark, sf):
    _, te, _, iva = folds(spark, sf)
    return te, M.choose_threshold(iva)


@query("confusion", txn_sql(CONF_SQL, ctes=BEST_CTE))
def confusion(spark, sf):
    """Frozen validation threshold evaluated once on test."""
    te, t = test_threshold(spark, sf)
    return M.confusion(te, t)


@query("savings", txn_sql("""
SELECT threshold, round(test_fraud_amount_caught + test_fraud_amount_missed, 6) AS total_fraud_amount, test_net_cost,
       round(test_fraud_amount_caught + test_fraud_amount_missed - test_net_cost, 6) AS savings
FROM (""" + CONF_SQL + ")", ctes=BEST_CTE))
def savings(spark, sf):
    """Savings vs approve-all on test at the frozen threshold."""
    te, t = test_threshold(spark, sf)
    return M.savings(te, t)


def _budget_sql(budgets: list[float]) -> str:
    vals = ", ".join(f"({b})" for b in budgets)
    return f"""bud AS (SELECT CAST(b AS DOUBLE) AS b, greatest(1, CAST(ceil((SELECT count(*) FROM ete) * CAST(b AS DOUBLE)) AS BIGINT)) AS k FROM (VALUES {vals}) v(b)),
rk AS (SELECT isFraud, amount_raw, row_number() OVER (ORDER BY score DESC, txn_id) - 1 AS pos FROM ete)"""


@query("review_budget", txn_sql("""
SELECT round(b * 100, 6) AS review_budget_pct, k AS flagged_rows, c AS fraud_caught, k - c AS false_positive_normals,
       round(c / k, 6) AS precision, round(c / (SELECT sum(isFraud) FROM ete), 6) AS fraud_recall
FROM (SELECT b, k, CAST((SELECT coalesce(sum(isFraud), 0) FROM rk WHERE pos < k) AS BIGINT) AS c FROM bud)""",
    ctes=EV_CTE + ",\n" + _budget_sql(M.REVIEW_BUDGETS)))
def review_budget(spark, sf):
    """Top-k review queues at 0.1 %...5 % budgets (distributed rank, ties by id)."""
    _, te, _, _ = folds(spark, sf)
    return M.review_budget(te)


@query("policy_queue", txn_sql("""
SELECT round(b * 100, 6) AS review_rate_pct, k AS k_transactions, round(c / k, 6) AS precision_at_k,
       round(CASE WHEN P > 0 THEN c / P ELSE 0.0 END, 6) AS recall_at_k, round(CASE WHEN PA <> 0 THEN a / PA ELSE 0.0 END, 6) AS fraud_amount_recall_at_k,
       c AS fraud_cases_caught_at_k, k - c AS normal_false_alerts_at_k
FROM (SELECT b, k, CAST((SELECT coalesce(sum(isFraud), 0) FROM rk WHERE pos < k) AS BIGINT) AS c,
             (SELECT coalesce(sum(CASE WHEN isFraud = 1 THEN amount_raw ELSE 0.0 END), 0.0) FROM rk WHERE pos < k) AS a,
             (SELECT sum(isFraud) FROM ete) AS P, (SELECT sum(CASE WHEN isFraud = 1 THEN amount_raw ELSE 0.0 END) FROM ete) AS PA FROM bud)""",
    ctes=EV_CTE + ",\n" + _budget_sql(M.POLICY_BUDGETS)))
def policy_queue(spark, sf):
    """Precision / recall / fraud-amount recall at k for the policy review rates."""
    _, te, _, _ = folds(spark, sf)
    return M.policy_queue(te)


@query("cost_sensitivity", txn_sql("""
SELECT c_fp, threshold, net_cost, n_fp, n_tp, n_fn FROM (
  SELECT *, row_number() OVER (PARTITION BY c_fp ORDER BY net_cost, n_fp, threshold) AS r FROM (
    SELECT c_fp, threshold, round(missed_fraud_amount + c_fp * n_fp, 6) AS net_cost, n_fp, n_tp, n_fn
    FROM sweep0, (VALUES (5.0::DOUBLE), (10.0::DOUBLE), (15.0::DOUBLE), (20.0::DOUBLE), (25.0::DOUBLE)) c(c_fp)
    WHERE threshold >= 0.0005 AND n_fp + n_tp < (SELECT count(*) FROM iva)))
WHERE r = 1""", ctes=EV_CTE + f",\nsweep0 AS ({_sweep_sql('iva', '0.0')})"))
def cost_sensitivity(spark, sf):
    """Best validation threshold for C_fp in 5, 10, 15, 20, 25."""
    _, _, _, iva = folds(spark, sf)
    return M.cost_sensitivity(iva)


@query("auc_pr_by_variant", txn_sql("""
SELECT type, max(CASE WHEN fold = 'train' THEN ap END) AS train, max(CASE WHEN fold = 'test' THEN ap END) AS test FROM (
  SELECT type, fold, round(CASE WHEN sum(n_pos) > 0 THEN sum(n_pos / P * cp / (cp + cn)) END, 6) AS ap FROM (
    SELECT *, sum(n_pos) OVER (PARTITION BY type, fold ORDER BY s DESC) AS cp, sum(n_neg) OVER (PARTITION BY type, fold ORDER BY s DESC) AS cn,
           sum(n_pos) OVER (PARTITION BY type, fold) AS P
    FROM (SELECT type, fold, score AS s, sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN isFraud = 1 THEN 0 ELSE 1 END) AS n_neg
          FROM (SELECT *, 'train' AS fold FROM etr UNION ALL SELECT *, 'test' AS fold FROM ete) GROUP BY type, fold, score))
  GROUP BY type, fold)
GROUP BY type""", ctes=EV_CTE))
def auc_pr_by_variant(spark, sf):
    """Average precision pivoted to one row per transaction type, one column per fold."""
    tr, te, _, _ = folds(spark, sf)
    both = tr.withColumn("fold", F.lit("train")).unionByName(te.withColumn("fold", F.lit("test")))
    ap = M.average_precision(both, group_cols=["type", "fold"]).withColumn("ap", F.round("average_precision", 6))
    return ap.groupBy("type").pivot("fold", ["train", "test"]).agg(F.first("ap"))
