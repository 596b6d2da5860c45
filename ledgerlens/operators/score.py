"""Scoring policy over batches and streams.

A scorer turns requests into decisions: transaction types outside the fraud
universe are auto-approved by rule, others get a probability, a REVIEW / BLOCK
/ APPROVE decision at the persisted threshold, the analyst-facing risk
signals and a reason. Destination velocity comes from history (batch: causal
windows; stream: keyed state in `streaming.velocity`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import features as FE

# fixed values: analyst-facing labels of the risk flags, in display order
RISK_SIGNAL_LABELS = [
    ("is_new_device", "transaction from a device never used by this account"),
    ("shipping_billing_mismatch", "shipping address differs from billing address"),
    ("ip_country_mismatch", "IP country differs from billing country"),
    ("young_account", "account is young (<= 90 days old)"),
    ("high_failed_attempts", "3+ failed payment attempts before this transaction"),
    ("is_night", "night-time transaction (00:00-05:59)"),
    ("dest_first_seen", "first transaction ever sent to this destination"),
]
VELOCITY_SIGNAL = "destination account already received %d prior transaction(s) (velocity)"
DECISIONS = ["AUTO_APPROVE", "APPROVE", "REVIEW", "BLOCK"]


def request_defaults(df: DataFrame) -> DataFrame:
    """P5: default a request's optional fields (step 744, hour from step, dest, balances 0)."""
    def opt(c: str, t: str) -> Column:
        return F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)

    # a missing step defaults to one past the horizon; 0 is a value (rejected by the contract)
    step = F.coalesce(opt("step", "long"), F.lit(S.DEFAULT_STEP).cast("long"))
    out = df.withColumn("step", step)
    hour = F.coalesce(opt("hour_of_day", "int"), F.pmod(F.col("step"), F.lit(24)).cast("int"))
    return out.withColumns({
        "hour_of_day": hour,
        "is_night": hour.between(0, 5).cast("int"),
        "nameDest": F.coalesce(opt("nameDest", "string"), F.lit(S.UNKNOWN_DEST)),
        **{c: F.coalesce(opt(c, "double"), F.lit(0.0)) for c in ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")},
    })


def velocity_state(df: DataFrame) -> DataFrame:
    """The stored state of each destination after the universe rows of `df`: (nameDest, state_count, state_step)."""
    u = df.where(F.col("type").isin(S.FRAUD_TYPES)).withColumn("nameDest", F.coalesce("nameDest", F.lit(S.UNKNOWN_DEST)))
    return u.groupBy("nameDest").agg(F.count(F.lit(1)).alias("state_count"), F.max("step").alias("state_step"))


def scoring_velocity(df: DataFrame, id_col: str = "txn_id", hot_threshold: int | None = None,
                     update_state: bool = True, history: DataFrame | None = None) -> DataFrame:
    """P6/P7 in batch: the velocity a stateful scorer sees when requests arrive in (step, id) order.

    Only universe rows without a caller-supplied `dest_prior_count` update the
    state; caller values win for their own row, with first_seen = (since < 0
    and prior = 0). `history` (see `velocity_state`) is the state that earlier
    batches left. With `update_state=False` (P8, dry run) no row updates the
    state, so every row sees the stored one unless it brings its own.
    """
    has_override = "dest_prior_count" in df.columns
    override = F.col("dest_prior_count").isNotNull() if has_override else F.lit(False)
    in_universe = F.col("type").isin(S.FRAUD_TYPES)
    x = df.withColumn("__state_row", in_universe & ~override & F.lit(update_state))
    x = x.withColumnRenamed("dest_prior_count", "__ov_prior") if has_override else x.withColumn("__ov_prior", F.lit(None).cast("long"))
    if "dest_steps_since_last" in df.columns:
        x = x.withColumnRenamed("dest_steps_since_last", "__ov_since")
    else:
        x = x.withColumn("__ov_since", F.lit(None).cast("double"))
    state_rows = x.where("__state_row")
    others = x.where(~F.col("__state_row"))
    v = FE.causal_velocity(state_rows, "nameDest", "dest", id_col=id_col, hot_threshold=hot_threshold)
    ov_since = F.coalesce(F.col("__ov_since").cast("double"), F.lit(-1.0))
    o = others.withColumns({
        "dest_prior_count": F.coalesce(F.col("__ov_prior").cast("long"), F.lit(0).cast("long")),
        "dest_steps_since_last": F.when(F.col("__ov_prior").isNotNull(), ov_since).otherwise(F.lit(-1.0)),
        "dest_first_seen": F.when(F.col("__ov_prior").isNotNull(), ((ov_since < 0) & (F.col("__ov_prior") == 0)).cast("int"))
                            .otherwise(F.lit(1)),
    })
    out = v.unionByName(o.select(*v.columns))
    if history is not None:
        # one row per destination: joins by Spark's choice, no broadcast hint
        out = out.join(history, "nameDest", "left")
        sees = F.col("state_count").isNotNull() & F.col("__ov_prior").isNull() & F.col("type").isin(S.FRAUD_TYPES)
        first = F.col("dest_first_seen") == 1
        out = out.withColumns({
            "dest_steps_since_last": F.when(sees & first, (F.col("step") - F.col("state_step")).cast("double")).otherwise(F.col("dest_steps_since_last")),
            "dest_prior_count": F.when(sees, F.col("dest_prior_count") + F.col("state_count")).otherwise(F.col("dest_prior_count")),
            "dest_first_seen": F.when(sees, F.lit(0)).otherwise(F.col("dest_first_seen")),
        }).drop("state_count", "state_step").select(*v.columns)
    return out.drop("__state_row", "__ov_prior", "__ov_since")


def decide(df: DataFrame, threshold: float, prob_col: str = "fraud_probability", block_threshold: float | None = None,
           model_label: str = "score", feature_set: str = "behavioural") -> DataFrame:
    """Rule path, decision, risk-signal array and reason sentence.

    Requires the flag columns of `features.row_features` and the velocity columns.
    """
    universe = F.col("type").isin(S.FRAUD_TYPES)
    p = F.col(prob_col)
    decision = F.when(~universe, F.lit("AUTO_APPROVE"))
    if block_threshold is not None:
        decision = decision.when(p >= F.lit(block_threshold), F.lit("BLOCK"))
    decision = decision.when(p >= F.lit(threshold), F.lit("REVIEW")).otherwise(F.lit("APPROVE"))
    labels = [F.when(F.col(flag) == 1, F.lit(text)) for flag, text in RISK_SIGNAL_LABELS]
    vel = F.when((F.col("dest_prior_count") > 0) & F.col("nameDest").isNotNull() & (F.col("nameDest") != S.UNKNOWN_DEST),
                 F.format_string(VELOCITY_SIGNAL, F.col("dest_prior_count").cast("int")))
    signals = F.filter(F.array(*labels, vel), lambda s: s.isNotNull())
    t_text = repr(float(threshold))
    reason = F.when(~universe, F.concat(
        F.lit("type="), F.col("type"), F.lit(f" is outside the fraud universe {list(S.FRAUD_TYPES)}; auto-approved by rule (0 observed fraud in these types)"),
    )).otherwise(F.concat(
        F.lit("score "), F.format_string("%.4f", p), F.lit(f" vs policy threshold {t_text} ({model_label}, {feature_set} variant)"),
    ))
    return df.withColumns({
        "fraud_probability": F.when(universe, p),
        "decision": decision,
        "risk_signals": F.when(universe, signals).otherwise(F.array().cast("array<string>")),
        "reason": reason,
        "threshold": F.lit(float(threshold)),
    })


def score_batch(requests: DataFrame, prob: Column | str, threshold: float, block_threshold: float | None = None,
                id_col: str = "txn_id", update_state: bool = True, hot_threshold: int | None = None,
                history: DataFrame | None = None) -> DataFrame:
    """P1-P9 for a batch of requests: defaults, velocity from history and batch, flags, decision."""
    r = request_defaults(requests)
    r = scoring_velocity(r, id_col=id_col, update_state=update_state, hot_threshold=hot_threshold, history=history)
    r = FE.row_features(r)
    pcol = F.col(prob) if isinstance(prob, str) else prob
    r = r.withColumn("__p", pcol)
    out = decide(r, threshold, "__p", block_threshold)
    return out.drop("__p")


MODEL_COLUMNS = ("features", "rawPrediction", "probability", "prediction")


def model_probability(rows: DataFrame, model, stats: dict[str, tuple[float, float]], out: str = "model_p") -> DataFrame:
    """M5/T7 inside the scorer: probability of a fitted pipeline for rows with raw features.

    One-hots (unless the rows bring them) and saved scaler statistics are applied to copies, so the rows keep
    the raw values that the flags, signals and reasons are made of. Works on
    batches and streams alike: it is a projection.
    """
    from .prep import apply_scaler
    from .train import predict_proba

    names = rows.columns
    # scaled columns, and columns named as the pipeline names its own
    kept = {c: f"__raw_{c}" for c in [*stats, *MODEL_COLUMNS] if c in names}
    coded = f"home_{FE.SORTED_COUNTRIES[0]}" in names
    x = (rows if coded else FE.one_hot(rows)).withColumns({r: F.col(c) for c, r in kept.items()})
    x = x.drop(*MODEL_COLUMNS)
    x = predict_proba(model, apply_scaler(x, stats), out)
    return x.withColumns({c: F.col(r) for c, r in kept.items()}).select(*names, out)


def score_with_model(requests: DataFrame, model, stats: dict[str, tuple[float, float]], policy: dict, id_col: str = "txn_id",
                     update_state: bool = True, history: DataFrame | None = None) -> DataFrame:
    """P1-P10 with a saved model, scaler statistics and policy document (`threshold`, optional `block_threshold`)."""
    r = scoring_velocity(request_defaults(requests), id_col=id_col, update_state=update_state, history=history)
    r = model_probability(FE.row_features(r), model, stats)
    return decide(r, float(policy["threshold"]), "model_p", policy.get("block_threshold"), policy.get("model", "model")).drop("model_p")


def decision_counts(scored: DataFrame) -> DataFrame:
    """Rows per decision."""
    return scored.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


def review_queue(scored: DataFrame, id_col: str = "txn_id") -> DataFrame:
    """REVIEW / BLOCK rows with their queue position (score desc, id asc; distributed rank)."""
    from .ranks import row_positions

    q = scored.where(F.col("decision").isin("REVIEW", "BLOCK"))
    return row_positions(q, [], "fraud_probability", id_col, descending=True, out="queue_position")


def outcome_kpis(scored: DataFrame, labels: DataFrame, id_col: str = "txn_id", label: str = S.LABEL,
                 amount: str = "amount") -> DataFrame:
    """Join decisions to outcome labels; caught / missed counts and value, wrong blocks, queue precision."""
    j = scored.select(id_col, "decision", amount).join(labels.select(id_col, label), id_col, "inner")
    flagged = F.col("decision").isin("REVIEW", "BLOCK")
    fraud = F.col(label) == 1
    return j.agg(
        F.sum((flagged & fraud).cast("int")).cast("long").alias("caught_count"),
        F.round(F.coalesce(F.sum(F.when(flagged & fraud, F.col(amount))), F.lit(0.0)), 6).alias("caught_value"),
        F.sum((~flagged & fraud).cast("int")).cast("long").alias("missed_count"),
        F.round(F.coalesce(F.sum(F.when(~flagged & fraud, F.col(amount))), F.lit(0.0)), 6).alias("missed_value"),
        F.sum(((F.col("decision") == "BLOCK") & ~fraud).cast("int")).cast("long").alias("wrong_blocks"),
        F.sum(flagged.cast("int")).cast("long").alias("queue_size"),
    ).withColumn("queue_precision", F.round(F.coalesce(F.try_divide(F.col("caught_count"), F.col("queue_size")), F.lit(0.0)), 6))


def resolve_cases(scored: DataFrame, log: DataFrame, id_col: str = "txn_id", scored_at: str = "step") -> DataFrame:
    """The queue with each case's standing analyst decision (null: pending).

    `log` holds (id, analyst_decision 'fraud' or 'legit', decided_at), in any
    order: decisions may come late, be repeated or be revised. The latest decision of a case stands; at equal
    times 'fraud' does. Decisions from before the case was scored, on cases
    outside the queue, or of another wording resolve nothing.
    """
    queue = scored.where(F.col("decision").isin("REVIEW", "BLOCK"))
    votes = log.where(F.col("analyst_decision").isin("fraud", "legit") & F.col("decided_at").isNotNull())
    votes = votes.select(F.col(id_col).alias("__case"), "decided_at", "analyst_decision")
    # votes are narrowed to the queue and to the time after scoring, then reduced to one row a case before the queue is joined
    cases = queue.select(F.col(id_col).alias("__case"), F.col(scored_at).alias("__at"))
    last = F.max(F.struct("decided_at", (F.col("analyst_decision") == "fraud").alias("fraud")))
    stands = votes.join(cases, "__case").where(F.col("decided_at") >= F.col("__at")).groupBy("__case").agg(last.alias("v"))
    stands = stands.select(F.col("__case").alias(id_col), F.col("v.decided_at").alias("decided_at"), F.when(F.col("v.fraud"), "fraud").otherwise("legit").alias("analyst_decision"))
    return queue.join(stands, id_col, "left")


def case_kpis(resolved: DataFrame, label: str = S.LABEL, amount: str = "amount") -> DataFrame:
    """Outcomes of resolved cases: fraud caught, fraud released in error, good orders blocked, precision of the queue."""
    said, fraud = F.col("analyst_decision"), F.col(label) == 1
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias
    value = lambda c: F.round(F.coalesce(F.sum(F.when(c, F.col(amount))), F.lit(0.0)), 6).alias
    caught, released, wrong = (said == "fraud") & fraud, (said == "legit") & fraud, (said == "fraud") & ~fraud
    none = F.lit(False)
    out = resolved.agg(
        count(said.isNotNull())("resolved"), count(said.isNull())("pending"),
        count(F.coalesce(caught, none))("caught_count"), value(caught)("caught_value"),
        count(F.coalesce(released, none))("released_in_error"), value(released)("released_value"),
        count(F.coalesce(wrong, none))("wrong_blocks"), count(said.isNotNull() & fraud)("resolved_fraud"))
    share = lambda c: F.round(F.coalesce(F.try_divide(F.col(c), F.col("resolved")), F.lit(0.0)), 6)
    right = F.col("resolved") - F.col("released_in_error") - F.col("wrong_blocks")
    return out.withColumns({"queue_precision": share("resolved_fraud"), "correct_share": F.round(F.coalesce(F.try_divide(right, F.col("resolved")), F.lit(0.0)), 6)}).drop("resolved_fraud")


def fill_scores(frame: DataFrame, model, stats: dict[str, tuple[float, float]], threshold: float, decided: bool = True,
                proba: str = "prediction_proba", prediction: str = "prediction") -> DataFrame:
    """MN2: rows without a logged probability are scored by the model; logged ones are left as they are.

    Only the rows without one go through the model. `decided` says that the log names
    decisions: then they are the predictions; without them a row is flagged if its probability reaches `threshold`.
    """
    names = frame.columns
    missing = model_probability(frame.where(F.col(proba).isNull()), model, stats, "__p").withColumn(proba, F.col("__p"))
    out = frame.where(F.col(proba).isNotNull()).unionByName(missing.select(*names))
    return out if decided else out.withColumn(prediction, (F.col(proba) >= F.lit(threshold)).cast("int"))
