"""Batch scoring and event-log queries (P1-P13, S7, S13, S14, Q28, Q29, MN2).

The probability is the deterministic evaluation `score` of the transaction
view (model training is covered by the rows-only ML queries); the threshold is
the one chosen on validation by `best_threshold`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import quality as Q
from ..operators import score as SC
from ..sources import events as EV
from ..sources.fixture import transactions
from .evaluate import BEST_CTE, test_threshold
from .registry import query, txn_sql


def scored(spark, sf):
    _, t = test_threshold(spark, sf)
    return SC.score_batch(transactions(spark, sf), "score", t), t


_SIG_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {flag} = 1 THEN '{text}' END" for flag, text in SC.RISK_SIGNAL_LABELS
) + ", CASE WHEN dest_prior_count > 0 AND nameDest IS NOT NULL AND nameDest <> 'UNKNOWN_DEST' THEN printf('destination account already received %d prior transaction(s) (velocity)', dest_prior_count) END], lambda x: x IS NOT NULL)"

_W = "(PARTITION BY nameDest ORDER BY step, txn_id)"
SCORED_CTE = BEST_CTE + f""",
vel AS (SELECT txn_id, row_number() OVER {_W} - 1 AS dest_prior_count,
               coalesce(CAST(step - lag(step) OVER {_W} AS DOUBLE), -1.0) AS dest_steps_since_last,
               CAST(lag(step) OVER {_W} IS NULL AS INTEGER) AS dest_first_seen
        FROM transactions WHERE type IN ('TRANSFER','CASH_OUT')),
sc0 AS (SELECT t.*, coalesce(v.dest_prior_count, 0) AS dest_prior_count, coalesce(v.dest_steps_since_last, -1.0) AS dest_steps_since_last,
               coalesce(v.dest_first_seen, 1) AS dest_first_seen,
               CAST(coalesce(t.ip_country <> t.home_billing_country, true) AS INTEGER) AS ip_country_mismatch,
               CAST(t.account_age_days <= 90 AS INTEGER) AS young_account, CAST(t.failed_payment_attempts >= 3 AS INTEGER) AS high_failed_attempts,
               (SELECT threshold FROM best) AS thr
        FROM transactions t LEFT JOIN vel v USING (txn_id)),
sc AS (SELECT *, CASE WHEN type NOT IN ('TRANSFER','CASH_OUT') THEN 'AUTO_APPROVE' WHEN score >= thr THEN 'REVIEW' ELSE 'APPROVE' END AS decision,
              CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN score END AS fraud_probability,
              CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN {_SIG_SQL} ELSE []::VARCHAR[] END AS risk_signals,
              CASE WHEN type NOT IN ('TRANSFER','CASH_OUT') THEN 'type=' || type || ' is outside the fraud universe [''TRANSFER'', ''CASH_OUT'']; auto-approved by rule (0 observed fraud in these types)'
                   ELSE 'score ' || printf('%.4f', score) || ' vs policy threshold ' || CAST(thr AS VARCHAR) || ' (score, behavioural variant)' END AS reason
       FROM sc0)"""


@query("decisions", txn_sql("""
SELECT txn_id, decision, fraud_probability, risk_signals, reason, dest_prior_count, dest_steps_since_last, dest_first_seen FROM sc""",
                            ctes=SCORED_CTE))
def decisions(spark, sf):
    """Rule path, decision, risk signals, reason and stateful destination velocity."""
    s, _ = scored(spark, sf)
    return s.select("txn_id", "decision", "fraud_probability", "risk_signals", "reason",
                    "dest_prior_count", "dest_steps_since_last", "dest_first_seen")


@query("decision_counts", txn_sql("SELECT decision, count(*) AS n FROM sc GROUP BY decision", ctes=SCORED_CTE))
def decision_counts(spark, sf):
    """Decisions per class."""
    s, _ = scored(spark, sf)
    return SC.decision_counts(s)


@query("review_queue", txn_sql("""
SELECT txn_id, fraud_probability, decision, row_number() OVER (ORDER BY fraud_probability DESC, txn_id) - 1 AS queue_position
FROM sc WHERE decision IN ('REVIEW', 'BLOCK')""", ctes=SCORED_CTE))
def review_queue(spark, sf):
    """Analyst queue of REVIEW / BLOCK rows by score (distributed rank, no row cap)."""
    s, _ = scored(spark, sf)
    return SC.review_queue(s.select("txn_id", "fraud_probability", "decision"))


@query("latest_scored", txn_sql("""
SELECT txn_id, step, decision FROM sc ORDER BY step DESC, txn_id DESC LIMIT 200""", ctes=SCORED_CTE))
def latest_scored(spark, sf):
    """The latest 200 scored rows (a top-k report: the limit is the feature)."""
    s, _ = scored(spark, sf)
    return s.select("txn_id", "step", "decision").orderBy(F.col("step").desc(), F.col("txn_id").desc()).limit(200)


@query("outcome_kpis", txn_sql("""
SELECT CAST(sum(CASE WHEN decision IN ('REVIEW','BLOCK') AND isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS caught_count,
       round(coalesce(sum(CASE WHEN decision IN ('REVIEW','BLOCK') AND isFraud = 1 THEN amount END), 0.0), 6) AS caught_value,
       CAST(sum(CASE WHEN decision NOT IN ('REVIEW','BLOCK') AND isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS missed_count,
       round(coalesce(sum(CASE WHEN decision NOT IN ('REVIEW','BLOCK') AND isFraud = 1 THEN amount END), 0.0), 6) AS missed_value,
       CAST(sum(CASE WHEN decision = 'BLOCK' AND isFraud = 0 THEN 1 ELSE 0 END) AS BIGINT) AS wrong_blocks,
       CAST(sum(CASE WHEN decision IN ('REVIEW','BLOCK') THEN 1 ELSE 0 END) AS BIGINT) AS queue_size,
       round(coalesce(sum(CASE WHEN decision IN ('REVIEW','BLOCK') AND isFraud = 1 THEN 1 ELSE 0 END)
             / nullif(sum(CASE WHEN decision IN ('REVIEW','BLOCK') THEN 1 ELSE 0 END), 0), 0.0), 6) AS queue_precision
FROM sc""", ctes=SCORED_CTE))
def outcome_kpis(spark, sf):
    """Analyst outcome KPIs from decisions joined to labels."""
    s, _ = scored(spark, sf)
    labels = transactions(spark, sf).select("txn_id", "isFraud")
    return SC.outcome_kpis(s.drop("isFraud"), labels)


# stand-in decision log over the queue: a decision soon after scoring (none for some cases), a revision of some,
# and for some a decision from before the case was scored, which counts for nothing
_CASES = """,
votes AS (
  SELECT txn_id, step + 1 + txn_id % 3 AS decided_at, CASE WHEN txn_id % 4 = 0 THEN 'legit' ELSE 'fraud' END AS analyst_decision FROM sc WHERE txn_id % 9 <> 0
  UNION ALL SELECT txn_id, step + 10, CASE WHEN txn_id % 4 = 0 THEN 'fraud' ELSE 'legit' END FROM sc WHERE txn_id % 5 = 0 AND txn_id % 9 <> 0
  UNION ALL SELECT txn_id, step - 2, 'legit' FROM sc WHERE txn_id % 6 = 0),
cases AS (
  SELECT sc.txn_id, sc.isFraud, sc.amount, v.decided_at, v.analyst_decision
  FROM sc LEFT JOIN (SELECT v.txn_id, max(v.decided_at) AS decided_at, arg_max(v.analyst_decision, v.decided_at) AS analyst_decision
                     FROM votes v JOIN sc USING (txn_id) WHERE v.decided_at >= sc.step GROUP BY v.txn_id) v USING (txn_id)
  WHERE sc.decision IN ('REVIEW', 'BLOCK'))"""


def _decision_log(spark, sf):
    t = transactions(spark, sf).select("txn_id", "step")
    late, odd = F.col("txn_id") % 5 == 0, F.col("txn_id") % 4 == 0
    vote = lambda at, legit: (at.alias("decided_at"), F.when(legit, "legit").otherwise("fraud").alias("analyst_decision"))
    worked = t.where("txn_id % 9 <> 0")
    first = worked.select("txn_id", *vote(F.col("step") + 1 + F.col("txn_id") % 3, odd))
    second = worked.where(late).select("txn_id", *vote(F.col("step") + 10, ~odd))
    early = t.where("txn_id % 6 = 0").select("txn_id", *vote(F.col("step") - 2, F.lit(True)))
    return first.unionByName(second).unionByName(early)


@query("resolved_cases", txn_sql("SELECT txn_id, isFraud, amount, decided_at, analyst_decision FROM cases", ctes=SCORED_CTE + _CASES))
def resolved_cases(spark, sf):
    """Every queued case with the analyst decision that stands (latest wins; null: pending)."""
    s, _ = scored(spark, sf)
    return SC.resolve_cases(s, _decision_log(spark, sf)).select("txn_id", "isFraud", "amount", "decided_at", "analyst_decision")


@query("case_outcomes", txn_sql("""
SELECT count(analyst_decision) AS resolved, count(*) - count(analyst_decision) AS pending,
       CAST(count(*) FILTER (analyst_decision = 'fraud' AND isFraud = 1) AS BIGINT) AS caught_count,
       round(coalesce(sum(amount) FILTER (analyst_decision = 'fraud' AND isFraud = 1), 0.0), 6) AS caught_value,
       CAST(count(*) FILTER (analyst_decision = 'legit' AND isFraud = 1) AS BIGINT) AS released_in_error,
       round(coalesce(sum(amount) FILTER (analyst_decision = 'legit' AND isFraud = 1), 0.0), 6) AS released_value,
       CAST(count(*) FILTER (analyst_decision = 'fraud' AND isFraud = 0) AS BIGINT) AS wrong_blocks,
       round(coalesce(CAST(count(*) FILTER (analyst_decision IS NOT NULL AND isFraud = 1) AS DOUBLE) / nullif(count(analyst_decision), 0), 0.0), 6) AS queue_precision,
       round(coalesce(CAST(count(*) FILTER ((analyst_decision = 'fraud') = (isFraud = 1)) AS DOUBLE) / nullif(count(analyst_decision), 0), 0.0), 6) AS correct_share
FROM cases""", ctes=SCORED_CTE + _CASES))
def case_outcomes(spark, sf):
    """KPIs of resolved cases: caught, released in error, good orders blocked, queue precision."""
    s, _ = scored(spark, sf)
    return SC.case_kpis(SC.resolve_cases(s, _decision_log(spark, sf)))


@query("contract_split", txn_sql("""
SELECT 'valid' AS status, count(*) AS n FROM transactions
WHERE type IN ('TRANSFER','CASH_OUT','PAYMENT','DEBIT','CASH_IN') AND amount > 0 AND account_age_days BETWEEN 0 AND 3650
  AND failed_payment_attempts BETWEEN 0 AND 12 AND ip_billing_distance_km >= 0 AND step >= 1 AND hour_of_day BETWEEN 0 AND 23
  AND home_billing_country IN ('US','GB','DE','FR','IN','BR','NG','RU','CN','VN') AND ip_country IN ('US','GB','DE','FR','IN','BR','NG','RU','CN','VN')
  AND oldbalanceOrg >= 0 AND newbalanceOrig >= 0 AND oldbalanceDest >= 0 AND newbalanceDest >= 0"""))
def contract_split(spark, sf):
    """Q29/Q30: request contract; valid rows counted, rejected rows carry reason arrays."""
    valid, rejected = Q.contract_split(transactions(spark, sf))
    v = valid.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("status"), "n")
    r = (rejected.select(F.explode("reject_reasons").alias("status")).groupBy("status")
         .agg(F.count(F.lit(1)).alias("n")))
    return v.unionByName(r)


def event_lines(spark, sf):
    s, _ = scored(spark, sf)
    return EV.stand_in_lines(EV.event_records(s))


_R = EV.stand_in_sql("")


@query("event_log_scan", txn_sql(f"""
SELECT count(*) AS n_lines, CAST(sum(CASE WHEN {_R['blank']} THEN 1 ELSE 0 END) AS BIGINT) AS blank_lines,
       CAST(sum(CASE WHEN NOT ({_R['blank']}) AND {_R['junk']} THEN 1 ELSE 0 END) AS BIGINT) AS malformed_lines,
       CAST(sum(CASE WHEN NOT ({_R['blank']}) AND NOT ({_R['junk']}) THEN 1 ELSE 0 END) AS BIGINT) AS parsed_events
FROM transactions"""))
def event_log_scan(spark, sf):
    """Tolerant JSON-lines scan of the scored-event log (blank skipped, malformed counted)."""
    return EV.tolerant_summary(EV.parse_lines(event_lines(spark, sf)))


@query("event_defaults", txn_sql(f"""
SELECT 'txn_' || CAST(txn_id AS VARCHAR) AS transaction_id, type,
       CAST(CASE WHEN {_R['opt_off']} THEN 744 ELSE step END AS BIGINT) AS step,
       CAST(CASE WHEN {_R['opt_off']} THEN 744 % 24 ELSE hour_of_day END AS INTEGER) AS hour_of_day,
       CAST(CASE WHEN {_R['opt_off']} THEN 744 % 24 ELSE hour_of_day END BETWEEN 0 AND 5 AS INTEGER) AS is_night,
       CASE WHEN {_R['opt_off']} THEN 'UNKNOWN_DEST' ELSE nameDest END AS nameDest,
       CASE WHEN {_R['opt_off']} THEN 0.0 ELSE oldbalanceOrg END AS oldbalanceOrg,
       CASE WHEN {_R['opt_off']} THEN 0.0 ELSE newbalanceOrig END AS newbalanceOrig,
       CASE WHEN {_R['opt_off']} THEN 0.0 ELSE oldbalanceDest END AS oldbalanceDest,
       CASE WHEN {_R['opt_off']} THEN 0.0 ELSE newbalanceDest END AS newbalanceDest,
       amount, account_age_days, failed_payment_attempts, ip_billing_distance_km, is_new_device, shipping_billing_mismatch,
       home_billing_country, ip_country,
       CASE WHEN {_R['no_label']} THEN CAST(isFraud AS DOUBLE) END AS isFraud,
       fraud_probability AS prediction_proba, CAST(decision IN ('REVIEW', 'BLOCK') AS INTEGER) AS prediction
FROM sc WHERE type IN ('TRANSFER','CASH_OUT') AND NOT ({_R['blank']}) AND NOT ({_R['junk']})""", ctes=SCORED_CTE))
def event_defaults(spark, sf):
    """Q12/Q28/MN2: parsed log events coerced and defaulted into the monitoring frame."""
    return EV.event_frame(EV.good_events(EV.parse_lines(event_lines(spark, sf))))


@query("current_source", txn_sql(f"""
SELECT 'events' AS source, count(*) AS n_rows
FROM sc WHERE type IN ('TRANSFER','CASH_OUT') AND NOT ({_R['blank']}) AND NOT ({_R['junk']})""", ctes=SCORED_CTE))
def current_source(spark, sf):
    """monitoring's current data is the event log when it holds any event, else the historical slice."""
    ev = EV.event_frame(EV.good_events(EV.parse_lines(event_lines(spark, sf))))
    if ev.limit(1).count() > 0:
        return ev.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("events").alias("source"), "n_rows")
    hist = transactions(spark, sf).where(F.col("type").isin(S.FRAUD_TYPES) & (F.col("step") > S.REFERENCE_MAX_STEP))
    return hist.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("historical").alias("source"), "n_rows")


@query("risk_signals", txn_sql("SELECT txn_id, risk_signals FROM sc WHERE type IN ('TRANSFER','CASH_OUT')", ctes=SCORED_CTE))
def risk_signals(spark, sf):
    """Analyst-facing risk signals (seven flags in fixed order + velocity sentence) of scored universe rows."""
    s, _ = scored(spark, sf)
    return s.where(F.col("type").isin(S.FRAUD_TYPES)).select("txn_id", "risk_signals")


_VCOLS = ["txn_id", "decision", "dest_prior_count", "dest_steps_since_last", "dest_first_seen"]


def _halves(spark, sf):
    """Requests up to the split step, whose state is stored, and those after it."""
    t = transactions(spark, sf)
    return t.where(F.col("step") <= S.REFERENCE_MAX_STEP), t.where(F.col("step") > S.REFERENCE_MAX_STEP)


@query("decisions_with_history", txn_sql(f"SELECT {', '.join(_VCOLS)} FROM sc WHERE step > {S.REFERENCE_MAX_STEP}", ctes=SCORED_CTE))
def decisions_with_history(spark, sf):
    """A later batch scored on the state that the earlier one stored equals scoring both at once."""
    _, t = test_threshold(spark, sf)
    early, late = _halves(spark, sf)
    return SC.score_batch(late, "score", t, history=SC.velocity_state(early)).select(*_VCOLS)


@query("dry_run", txn_sql(f"""
SELECT sc.txn_id, sc.decision, CASE WHEN sc.fraud_probability IS NULL THEN 0 ELSE coalesce(h.n, 0) END AS dest_prior_count,
       CASE WHEN sc.fraud_probability IS NULL OR h.n IS NULL THEN -1.0 ELSE CAST(sc.step - h.s AS DOUBLE) END AS dest_steps_since_last,
       CASE WHEN sc.fraud_probability IS NULL OR h.n IS NULL THEN 1 ELSE 0 END AS dest_first_seen
FROM sc LEFT JOIN (SELECT nameDest, count(*) AS n, max(step) AS s FROM transactions
                   WHERE type IN ('TRANSFER','CASH_OUT') AND step <= {S.REFERENCE_MAX_STEP} GROUP BY nameDest) h USING (nameDest)
WHERE sc.step > {S.REFERENCE_MAX_STEP}""", ctes=SCORED_CTE))
def dry_run(spark, sf):
    """A dry run reads the stored state and leaves it as it is, so every row sees the same history."""
    _, t = test_threshold(spark, sf)
    early, late = _halves(spark, sf)
    return SC.score_batch(late, "score", t, update_state=False, history=SC.velocity_state(early)).select(*_VCOLS)


BLOCK_AT = 0.5


@query("decisions_with_block", txn_sql(f"""
SELECT CASE WHEN fraud_probability >= {BLOCK_AT}::DOUBLE THEN 'BLOCK' ELSE decision END AS decision, count(*) AS n,
       CAST(sum(isFraud) AS BIGINT) AS fraud FROM sc GROUP BY 1""", ctes=SCORED_CTE))
def decisions_with_block(spark, sf):
    """Decisions with a BLOCK tier above REVIEW, counted with their fraud."""
    _, t = test_threshold(spark, sf)
    s = SC.score_batch(transactions(spark, sf), "score", t, block_threshold=BLOCK_AT)
    return s.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.sum("isFraud").cast("long").alias("fraud"))


_OW = "(PARTITION BY nameDest ORDER BY step, txn_id)"


@query("velocity_override", txn_sql(f"""
SELECT t.txn_id, CASE WHEN t.txn_id % 7 = 0 THEN 3 ELSE coalesce(v.n, 0) END AS dest_prior_count,
       CASE WHEN t.txn_id % 7 = 0 THEN 2.0 ELSE coalesce(v.since, -1.0) END AS dest_steps_since_last,
       CASE WHEN t.txn_id % 7 = 0 THEN 0 ELSE coalesce(v.first, 1) END AS dest_first_seen
FROM transactions t LEFT JOIN (
  SELECT txn_id, row_number() OVER {_OW} - 1 AS n, CAST(step - lag(step) OVER {_OW} AS DOUBLE) AS since,
         CAST(lag(step) OVER {_OW} IS NULL AS INTEGER) AS first
  FROM transactions WHERE type IN ('TRANSFER','CASH_OUT') AND txn_id % 7 <> 0) v USING (txn_id)"""))
def velocity_override(spark, sf):
    """Velocity that the caller supplies wins for its own row and leaves the state alone."""
    own = F.col("txn_id") % 7 == 0
    req = transactions(spark, sf).withColumns({
        "dest_prior_count": F.when(own, F.lit(3)).cast("long"), "dest_steps_since_last": F.when(own, F.lit(2.0))})
    v = SC.scoring_velocity(SC.request_defaults(req))
    return v.select("txn_id", "dest_prior_count", "dest_steps_since_last", "dest_first_seen")


@query("event_log_roundtrip", txn_sql("""
SELECT count(*) AS n_lines, CAST(0 AS BIGINT) AS blank_lines, CAST(0 AS BIGINT) AS malformed_lines, count(*) AS parsed_events,
       count(*) AS counted, round(sum(fraud_probability), 4) AS probability, round(sum(amount), 2) AS amount FROM sc""", ctes=SCORED_CTE))
def event_log_roundtrip(spark, sf):
    """Scored events written as a JSON-lines log, counted and read back by the tolerant reader."""
    from ..functions.exprs import one_row
    from ..streaming.jobs import scratch

    s, _ = scored(spark, sf)
    path = scratch(spark, "event-log")
    EV.write_event_log(EV.event_records(s), path)
    events, summary = EV.read_event_log(spark, path)
    sums = events.agg(F.round(F.sum(F.col("fraud_probability").try_cast("double")), 4).alias("probability"),
                      F.round(F.sum(F.col("amount").try_cast("double")), 2).alias("amount"))
    return one_row(summary, sums).withColumn("counted", F.lit(EV.count_logged_events(spark, path)).cast("long"))


@query("table_roundtrip", txn_sql("""
SELECT type, count(*) AS n, round(sum(amount), 2) AS amount, count(*) AS csv_n, round(sum(amount), 2) AS csv_amount,
       count(*) AS result_n FROM transactions GROUP BY type"""))
def table_roundtrip(spark, sf):
    """Base table written as CSV and parquet, read back whole and projected, and a result written as CSV."""
    from ..sources import tables as TB
    from ..streaming.jobs import scratch

    t = Q.require_columns(transactions(spark, sf), S.BASE_COLUMNS).select(*S.BASE_COLUMNS)
    csv, pq, res = (scratch(spark, f"table-{k}") for k in ("csv", "parquet", "result"))
    t.write.option("header", True).csv(csv)
    TB.write_parquet(t, pq)
    whole, part = TB.read_base_csv(spark, csv), TB.read_base_csv(spark, csv, ["type", "amount"])
    if not Q.same_columns(t, whole):
        raise ValueError("columns changed on the way through CSV")
    a = TB.read_enriched(spark, pq, ["type", "amount"]).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))
    b = part.groupBy("type").agg(F.count(F.lit(1)).alias("csv_n"), F.round(F.sum("amount"), 2).alias("csv_amount"))
    TB.write_result_csv(whole.groupBy("type").agg(F.count(F.lit(1)).alias("result_n")), res)
    c = spark.read.schema("type string, result_n long").option("header", True).csv(res)
    return a.join(b, "type").join(c, "type")


@query("filled_ids", txn_sql("""
SELECT count(*) AS n, count(DISTINCT txn_id) AS distinct_ids, CAST(sum(CASE WHEN txn_id % 5 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN txn_id % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS generated FROM transactions"""))
def filled_ids(spark, sf):
    """Q31: missing transaction ids filled with `txn_` and 12 hex digits of the row's hash."""
    t = transactions(spark, sf)
    t = t.withColumn("transaction_id", F.when(F.col("txn_id") % 5 != 0, F.concat(F.lit("id_"), F.col("txn_id").cast("string"))))
    out = Q.fill_transaction_id(t)
    made = F.col("transaction_id").rlike("^txn_[0-9a-f]{12}$")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_id").alias("distinct_ids"),
                   F.sum((~made).cast("int")).cast("long").alias("kept"), F.sum(made.cast("int")).cast("long").alias("generated"))
