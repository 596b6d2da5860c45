"""Exploration queries (A*) over the transaction table, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore as X
from ..sources.fixture import transactions
from .registry import query, txn_sql


def _rate_sql(key_expr: str, name: str, where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return txn_sql(f"""
SELECT {name}, count(isFraud) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud,
       round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct
FROM (SELECT {key_expr} AS {name}, isFraud FROM transactions {w}) t
WHERE {name} IS NOT NULL GROUP BY {name}""")


@query("fraud_rate_by_type", _rate_sql("type", "type"))
def fraud_rate_by_type(spark, sf):
    """A1: fraud rate by transaction type."""
    return X.fraud_rate_by(transactions(spark, sf), "type")


@query("fraud_rate_by_hour", _rate_sql("step % 24", "hour"))
def fraud_rate_by_hour(spark, sf):
    """Fraud rate by hour of day = step % 24."""
    return X.fraud_rate_by(transactions(spark, sf), F.pmod("step", F.lit(24)), "hour")


@query("fraud_rate_by_dest_kind",
       _rate_sql("CASE WHEN starts_with(nameDest, 'M') THEN 'merchant (M)' ELSE 'customer (C)' END", "dest_type"))
def fraud_rate_by_dest_kind(spark, sf):
    """Merchant vs customer destination."""
    return X.fraud_rate_by(transactions(spark, sf), X.dest_kind(), "dest_type")


@query("fraud_rate_by_attempts", _rate_sql("failed_payment_attempts", "failed_payment_attempts"))
def fraud_rate_by_attempts(spark, sf):
    """Fraud rate per failed-attempt count."""
    return X.fraud_rate_by(transactions(spark, sf), "failed_payment_attempts")


@query("fraud_rate_by_flagged", _rate_sql("isFlaggedFraud", "isFlaggedFraud"))
def fraud_rate_by_flagged(spark, sf):
    """Fraud rate by the existing rule flag."""
    return X.fraud_rate_by(transactions(spark, sf), "isFlaggedFraud")


@query("fraud_rate_by_merchant",
       _rate_sql("CAST(starts_with(nameDest, 'M') AS INTEGER)", "dest_is_merchant"))
def fraud_rate_by_merchant(spark, sf):
    """Fraud rate by the merchant-destination flag."""
    return X.fraud_rate_by(transactions(spark, sf), F.col("nameDest").startswith("M").cast("int"), "dest_is_merchant")


@query("value_at_risk", txn_sql("""
SELECT n, fraud, round(prev * 100.0, 6) AS prevalence_pct,
       CAST(CASE WHEN prev > 0 THEN round_even(1.0 / prev, 0) END AS BIGINT) AS one_in_k,
       round(coalesce(fv, 0.0), 6) AS fraud_value, round(tv, 6) AS total_value,
       round(CASE WHEN tv <> 0 THEN coalesce(fv, 0.0) / tv END * 100.0, 6) AS value_share_pct
FROM (SELECT count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud, avg(isFraud) AS prev,
             sum(CASE WHEN isFraud = 1 THEN amount END) AS fv, sum(amount) AS tv FROM transactions)"""))
def value_at_risk(spark, sf):
    """A2: imbalance and value at risk."""
    return X.value_at_risk(transactions(spark, sf))


@query("universe_prevalence", txn_sql("""
SELECT count(*) AS n_rows, round(avg(isFraud) * 100.0, 6) AS overall_rate_pct,
       CAST(sum(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END) AS BIGINT) AS universe_rows,
       CAST(sum(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN isFraud END) AS BIGINT) AS universe_fraud,
       round(avg(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN isFraud END) * 100.0, 6) AS universe_rate_pct
FROM transactions"""))
def universe_prevalence(spark, sf):
    """A3: prevalence inside the fraud universe vs overall."""
    return X.universe_prevalence(transactions(spark, sf))


@query("amount_describe_by_class", txn_sql("""
SELECT isFraud, round(avg(amount), 6) AS mean, round(quantile_cont(amount, 0.5), 6) AS p50,
       round(quantile_cont(amount, 0.9), 6) AS p90, round(quantile_cont(amount, 0.99), 6) AS p99,
       round(max(amount), 6) AS max
FROM transactions GROUP BY isFraud"""))
def amount_describe_by_class(spark, sf):
    """A4: amount describe by class with exact quantiles."""
    return X.amount_describe_by_class(transactions(spark, sf))


@query("amount_hist", txn_sql("""
SELECT x.isFraud, CAST(least(floor((x - lo) / w), 59) AS INTEGER) AS bin, count(*) AS n,
       round(first(lo) + CAST(least(floor((x - lo) / w), 59) AS INTEGER) * first(w), 6) AS bin_lo,
       round(count(*) / (first(N) * first(w)), 6) AS density
FROM x JOIN rng USING (isFraud)
GROUP BY x.isFraud, CAST(least(floor((x - lo) / w), 59) AS INTEGER)""", ctes="""
x AS (SELECT isFraud, log10(amount) AS x FROM transactions WHERE amount > 0),
r0 AS (SELECT isFraud, min(x) AS lo, max(x) AS hi, count(*) AS N FROM x GROUP BY isFraud),
rng AS (SELECT isFraud, N, lo2 AS lo, (hi2 - lo2) / 60.0 AS w FROM (
        SELECT isFraud, N, CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo2,
               CASE WHEN hi > lo THEN hi ELSE hi + 0.5 END AS hi2 FROM r0))"""))
def amount_hist(spark, sf):
    """A5: 60-bin log10(amount) density histogram per class."""
    return X.amount_hist(transactions(spark, sf))


@query("class_counts", txn_sql("""
SELECT isFraud, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM transactions GROUP BY isFraud"""))
def class_counts(spark, sf):
    """Class counts and normalised shares."""
    return X.class_counts(transactions(spark, sf))


@query("balance_mechanics", txn_sql("""
SELECT n_fraud, drained_fraud, round(drained_fraud / greatest(n_fraud, 1) * 100.0, 6) AS drained_pct, orig_err_nonzero_pct
FROM (SELECT CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_fraud,
             CAST(sum(CASE WHEN isFraud = 1 AND abs(newbalanceOrig - 0.0) <= 1e-8 + 1e-5 * abs(0.0) THEN 1 ELSE 0 END) AS BIGINT) AS drained_fraud,
             round(avg(CASE WHEN abs((oldbalanceOrg - amount - newbalanceOrig) - 0.0) <= 1e-8 + 1e-5 * abs(0.0) THEN 0 ELSE 1 END) * 100.0, 6) AS orig_err_nonzero_pct
      FROM transactions)"""))
def balance_mechanics(spark, sf):
    """Balance mechanics summary."""
    return X.balance_mechanics(transactions(spark, sf))


@query("ledger_errors_by_class", txn_sql("""
SELECT isFraud, round(avg(oldbalanceOrg - amount - newbalanceOrig), 6) AS mean_orig_err,
       round(avg(oldbalanceDest + amount - newbalanceDest), 6) AS mean_dest_err,
       round(avg(CAST(newbalanceOrig = 0 AND abs(oldbalanceOrg - amount) <= 1e-8 + 1e-5 * abs(amount) AS INTEGER)), 6) AS origin_emptied_rate
FROM transactions GROUP BY isFraud"""))
def ledger_errors_by_class(spark, sf):
    """Mean ledger errors and origin-emptied rate by class."""
    return X.ledger_errors_by_class(transactions(spark, sf))


@query("rule_effectiveness", txn_sql("""
SELECT fires, caught, total_fraud, round(caught / greatest(total_fraud, 1) * 100.0, 6) AS recall_pct
FROM (SELECT CAST(sum(CASE WHEN isFlaggedFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fires,
             CAST(sum(CASE WHEN isFlaggedFraud = 1 AND isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS caught,
             CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_fraud FROM transactions)"""))
def rule_effectiveness(spark, sf):
    """A10: existing-rule effectiveness."""
    return X.rule_effectiveness(transactions(spark, sf))


def _corr_sql(cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM transactions")
    return txn_sql("\nUNION ALL\n".join(parts))


@query("corr_matrix", _corr_sql(X.BASE_NUMERIC))
def corr_matrix(spark, sf):
    """Pearson correlation matrix of the base numeric columns."""
    return X.corr_matrix(transactions(spark, sf))


def _lift_sql(flags: list[str]) -> str:
    parts = [f"SELECT '{f}' AS signal, avg(CASE WHEN {f} = 1 THEN isFraud END) * 100.0 AS r1, "
             f"avg(CASE WHEN {f} = 0 THEN isFraud END) * 100.0 AS r0 FROM transactions" for f in flags]
    return txn_sql(
        "SELECT signal, round(r1, 6) AS rate_1_pct, round(r0, 6) AS rate_0_pct, "
        "round(CASE WHEN r0 <> 0 THEN r1 / r0 END, 6) AS lift_x FROM (" + " UNION ALL ".join(parts) + ")"
    )


@query("flag_lift", _lift_sql(X.CONTEXT_FLAGS))
def flag_lift(spark, sf):
    """Lift table of the binary risk flags."""
    return X.flag_lift(transactions(spark, sf))


def _deciles_sql(cols: list[str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT txn_id, isFraud, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM transactions" for c in cols
    )
    return txn_sql("""
SELECT feature, CAST(greatest(CASE WHEN n > 1 THEN (pos * 10 + n - 2) // (n - 1) ELSE 1 END, 1) - 1 AS INTEGER) AS decile,
       count(*) AS n, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct
FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY v, txn_id) - 1 AS pos,
             count(*) OVER (PARTITION BY feature) AS n FROM long WHERE v IS NOT NULL)
GROUP BY ALL""", ctes=f"long AS ({long})")


@query("age_deciles", _deciles_sql(X.CONTEXT_NUMBERS))
def age_deciles(spark, sf):
    """Fraud rate by rank decile of age, attempts and distance (ties by id)."""
    return X.rank_deciles(transactions(spark, sf))


def _label_corr_sql(cols: list[str], source: str = "transactions") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(isFraud AS DOUBLE)), 6) AS corr_with_isFraud, "
        f"round(abs(corr(CAST({c} AS DOUBLE), CAST(isFraud AS DOUBLE))), 6) AS abs_corr FROM {source}" for c in cols
    )


@query("signal_corr", txn_sql(_label_corr_sql(X.CONTEXT_FLAGS + X.CONTEXT_NUMBERS)))
def signal_corr(spark, sf):
    """Correlation of each synthetic signal with the label."""
    return X.label_corr(transactions(spark, sf), X.CONTEXT_FLAGS + X.CONTEXT_NUMBERS)


@query("flag_stack", txn_sql("""
SELECT is_new_device + shipping_billing_mismatch + is_night AS n_flags, count(*) AS n,
       CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct
FROM transactions GROUP BY 1"""))
def flag_stack(spark, sf):
    """Fraud rate by number of active flags."""
    return X.flag_stack(transactions(spark, sf))


@query("type_summary_shares", txn_sql("""
SELECT type, count(*) AS total_transactions, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
       round(sum(amount), 6) AS total_amount, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct,
       round(count(*) / sum(count(*)) OVER () * 100.0, 6) AS transaction_share_pct,
       round(CASE WHEN sum(sum(isFraud)) OVER () <> 0 THEN sum(isFraud) / sum(sum(isFraud)) OVER () END * 100.0, 6) AS fraud_share_pct
FROM transactions GROUP BY type"""))
def type_summary_shares(spark, sf):
    """Type summary with value, transaction share and fraud share."""
    return X.type_summary_shares(transactions(spark, sf))


def _percentiles_sql() -> str:
    basic = """
SELECT 'count' AS stat, CAST(count(amount) AS DOUBLE) AS value FROM transactions UNION ALL
SELECT 'mean', avg(amount) FROM transactions UNION ALL
SELECT 'std', stddev_samp(amount) FROM transactions UNION ALL
SELECT 'min', min(amount) FROM transactions UNION ALL
SELECT 'max', max(amount) FROM transactions"""
    qs = " UNION ALL ".join(
        f"SELECT 'p{round(p * 1000)}', quantile_cont(amount, {p}) FROM transactions" for p in X.DESCRIBE_PROBS
    )
    return txn_sql(f"SELECT stat, round(value, 6) AS value FROM ({basic} UNION ALL {qs})")


@query("amount_percentiles", _percentiles_sql())
def amount_percentiles(spark, sf):
    """Describe of amount with ten percentiles (names are per-mille)."""
    return X.amount_percentiles(transactions(spark, sf))


@query("amount_value_deciles", txn_sql("""
SELECT greatest(CAST(len(list_filter(e.q, lambda x: x < t.amount)) AS INTEGER) - 1, 0) AS bin,
       count(*) AS n, round(avg(t.isFraud) * 100.0, 6) AS fraud_rate_pct
FROM transactions t, e
GROUP BY 1""", ctes="""
e AS (SELECT list_sort(list_distinct(quantile_cont(amount, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS q
      FROM transactions)"""))
def amount_value_deciles(spark, sf):
    """Fraud rate by value-quantile decile of amount (duplicate edges dropped)."""
    return X.amount_value_deciles(transactions(spark, sf))


def _bins_sql(expr: str, edges: list[float], labels: list[str]) -> str:
    arms = " ".join(
        f"WHEN v > {edges[i]} AND v <= {edges[i + 1]} THEN '{labels[i]}'" for i in range(len(labels))
    )
    return txn_sql(f"""
SELECT bucket, count(*) AS n, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct
FROM (SELECT CASE {arms} END AS bucket, isFraud FROM (SELECT {expr} AS v, isFraud FROM transactions))
WHERE bucket IS NOT NULL GROUP BY bucket""")


@query("distance_bins", _bins_sql("ip_billing_distance_km", X.DISTANCE_EDGES, X.DISTANCE_LABELS))
def distance_bins(spark, sf):
    """Fraud rate by right-closed IP-distance bins."""
    return X.rate_by_bins(transactions(spark, sf), F.col("ip_billing_distance_km"), X.DISTANCE_EDGES, X.DISTANCE_LABELS)


@query("ratio_bins", _bins_sql("amount / (oldbalanceOrg + 1.0)", X.RATIO_EDGES, X.RATIO_LABELS))
def ratio_bins(spark, sf):
    """Fraud rate by right-closed amount / origin-balance ratio bins."""
    ratio = F.col("amount") / (F.col("oldbalanceOrg") + F.lit(1.0))
    return X.rate_by_bins(transactions(spark, sf), ratio, X.RATIO_EDGES, X.RATIO_LABELS)


@query("scoping_retention", txn_sql("""
SELECT rows_before, fraud_before, rows_after, fraud_after,
       round(fraud_before / rows_before * 100.0, 6) AS rate_before_pct,
       round(CASE WHEN rows_after <> 0 THEN fraud_after / rows_after END * 100.0, 6) AS rate_after_pct,
       round(CASE WHEN fraud_before <> 0 THEN fraud_after / fraud_before END * 100.0, 6) AS fraud_retained_pct
FROM (SELECT count(*) AS rows_before, CAST(sum(isFraud) AS BIGINT) AS fraud_before,
             CAST(sum(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END) AS BIGINT) AS rows_after,
             CAST(sum(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN isFraud END) AS BIGINT) AS fraud_after
      FROM transactions)"""))
def scoping_retention(spark, sf):
    """Fraud retention through type scoping."""
    return X.scoping_retention(transactions(spark, sf))
