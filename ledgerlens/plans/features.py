"""Feature-engineering queries (FE*, A22-A24), with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import round_doubles
from ..operators import explore as X
from ..operators import features as FE
from ..sources.fixture import transactions
from .registry import query, txn_sql

# DuckDB expressions of the row-wise features (same formulas, same order of operations)
ROW_SQL = {
    "log_amount": "log10(amount + 1.0)",
    "orig_balance_err": "oldbalanceOrg - amount - newbalanceOrig",
    "dest_balance_err": "oldbalanceDest + amount - newbalanceDest",
    "drained_origin": "CAST(newbalanceOrig = 0 AND oldbalanceOrg > 0 AS INTEGER)",
    "origin_emptied": "CAST(newbalanceOrig = 0 AND abs(oldbalanceOrg - amount) <= 1e-8 + 1e-5 * abs(amount) AS INTEGER)",
    "amount_to_oldbalanceOrg": "amount / (oldbalanceOrg + 1.0)",
    "dest_balances_masked": "CAST(oldbalanceDest = 0 AND newbalanceDest = 0 AS INTEGER)",
    "ip_country_mismatch": "CAST(coalesce(ip_country <> home_billing_country, true) AS INTEGER)",
    "log_ip_distance": "log10(ip_billing_distance_km + 1.0)",
    "young_account": "CAST(account_age_days <= 90 AS INTEGER)",
    "high_failed_attempts": "CAST(failed_payment_attempts >= 3 AS INTEGER)",
    "hour_sin": "sin(2 * pi() * CAST(hour_of_day AS DOUBLE) / 24.0)",
    "hour_cos": "cos(2 * pi() * CAST(hour_of_day AS DOUBLE) / 24.0)",
    "is_transfer": "CAST(type = 'TRANSFER' AS INTEGER)",
}
DOUBLE_FEATURES = {"log_amount", "orig_balance_err", "dest_balance_err", "amount_to_oldbalanceOrg", "log_ip_distance",
                   "hour_sin", "hour_cos", "dest_steps_since_last", "amount", "oldbalanceOrg", "newbalanceOrig",
                   "oldbalanceDest", "newbalanceDest", "ip_billing_distance_km", "amount_raw", "orig_time_since_last",
                   "dest_prior_amount_sum"}


def _r(name: str, expr: str) -> str:
    return f"round({expr}, 6) AS {name}" if name in DOUBLE_FEATURES else f"{expr} AS {name}"


def _vel_sql(key: str, prefix: str, names: dict[str, str] | None = None) -> dict[str, str]:
    names = names or {}
    w = f"(PARTITION BY {key} ORDER BY step, txn_id)"
    return {
        names.get("prior_count", f"{prefix}_prior_count"): f"row_number() OVER {w} - 1",
        names.get("steps_since_last", f"{prefix}_steps_since_last"): f"coalesce(CAST(step - lag(step) OVER {w} AS DOUBLE), -1.0)",
        names.get("first_seen", f"{prefix}_first_seen"): f"CAST(lag(step) OVER {w} IS NULL AS INTEGER)",
    }


ONE_HOT_SQL = {
    f"{p}_{v}": f"CAST(coalesce({c} = '{v}', false) AS INTEGER)"
    for p, c in (("home", "home_billing_country"), ("ip", "ip_country")) for v in FE.SORTED_COUNTRIES
}


@query("features_row", txn_sql("SELECT txn_id, " + ", ".join(_r(k, v) for k, v in ROW_SQL.items()) + " FROM transactions"))
def features_row(spark, sf):
    """FE1-FE11, FE18, FE19: row-wise features."""
    t = transactions(spark, sf)
    f = FE.row_features(t)
    return round_doubles(f.select("txn_id", *ROW_SQL))


@query("dest_velocity", txn_sql("SELECT txn_id, " + ", ".join(_r(k, v) for k, v in _vel_sql("nameDest", "dest").items()) + " FROM transactions"))
def dest_velocity(spark, sf):
    """FE12, FE14, FE15: causal destination velocity over all types."""
    v = FE.dest_velocity(transactions(spark, sf))
    return v.select("txn_id", "dest_prior_count", "dest_steps_since_last", "dest_first_seen")


@query("dest_velocity_hot_split", txn_sql("SELECT txn_id, " + ", ".join(_r(k, v) for k, v in _vel_sql("nameDest", "dest").items()) + " FROM transactions"))
def dest_velocity_hot_split(spark, sf):
    """FE12-FE15 with every destination above 20 rows routed through the hot-key split path."""
    v = FE.dest_velocity(transactions(spark, sf), hot_threshold=20)
    return v.select("txn_id", "dest_prior_count", "dest_steps_since_last", "dest_first_seen")


@query("dest_velocity_scoped", txn_sql("SELECT txn_id, " + ", ".join(_r(k, v) for k, v in _vel_sql("nameDest", "dest").items())
                                       + " FROM transactions WHERE type IN ('TRANSFER','CASH_OUT')"))
def dest_velocity_scoped(spark, sf):
    """FE12-FE15, monitoring variant: scope to the fraud universe first, then destination velocity."""
    t = transactions(spark, sf).where(F.col("type").isin(S.FRAUD_TYPES))
    return FE.dest_velocity(t).select("txn_id", "dest_prior_count", "dest_steps_since_last", "dest_first_seen")


_ORIG_NAMES = {"steps_since_last": "orig_time_since_last", "first_seen": "is_first_orig_txn"}


@query("orig_velocity", txn_sql("SELECT txn_id, " + ", ".join(_r(k, v) for k, v in _vel_sql("nameOrig", "orig", _ORIG_NAMES).items()) + " FROM transactions"))
def orig_velocity(spark, sf):
    """FE13, FE17: origin velocity (degenerate: origins are near-unique)."""
    v = FE.orig_velocity(transactions(spark, sf))
    return v.select("txn_id", "orig_prior_count", "orig_time_since_last", "is_first_orig_txn")


_PA_W = "(PARTITION BY nameDest ORDER BY step, txn_id)"


@query("dest_prior_amount", txn_sql(f"""
SELECT txn_id, row_number() OVER {_PA_W} - 1 AS dest_prior_txn_count,
       round(coalesce(sum(amount) OVER (PARTITION BY nameDest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 6) AS dest_prior_amount_sum
FROM transactions"""))
def dest_prior_amount(spark, sf):
    """FE16: amount received by the destination before this row."""
    v = FE.dest_prior_amount(transactions(spark, sf))
    return round_doubles(v.select("txn_id", "dest_prior_txn_count", "dest_prior_amount_sum"))


@query("dest_prior_amount_hot_split", txn_sql(f"""
SELECT txn_id, row_number() OVER {_PA_W} - 1 AS dest_prior_txn_count,
       round(coalesce(sum(amount) OVER (PARTITION BY nameDest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 6) AS dest_prior_amount_sum
FROM transactions"""))
def dest_prior_amount_hot_split(spark, sf):
    """FE16 through the hot-key split path (destinations above 20 rows)."""
    v = FE.dest_prior_amount(transactions(spark, sf), hot_threshold=20)
    return round_doubles(v.select("txn_id", "dest_prior_txn_count", "dest_prior_amount_sum"))


@query("one_hot", txn_sql("SELECT txn_id, " + ", ".join(f"{v} AS {k}" for k, v in ONE_HOT_SQL.items()) + ", " + ", ".join(
    f"CAST(coalesce(type = '{v}', false) AS INTEGER) AS type_{v}" for v in sorted(S.ALL_TYPES)) + " FROM transactions"))
def one_hot(spark, sf):
    """FE20/FE21: fixed-vocabulary country and type one-hots."""
    t = transactions(spark, sf)
    o = FE.one_hot(t, with_type=True)
    return o.select("txn_id", *[c for c in o.columns if c not in t.columns])


@query("velocity_spread", txn_sql(f"""
SELECT round(avg(d), 6) AS mean_dest_prior_count, max(d) AS max_dest_prior_count, max(o) AS max_orig_prior_count
FROM (SELECT row_number() OVER (PARTITION BY nameDest ORDER BY step, txn_id) - 1 AS d,
             row_number() OVER (PARTITION BY nameOrig ORDER BY step, txn_id) - 1 AS o FROM transactions)"""))
def velocity_spread(spark, sf):
    """Velocity spread and origin degeneracy."""
    v = FE.orig_velocity(FE.dest_velocity(transactions(spark, sf)))
    return v.agg(
        F.round(F.avg("dest_prior_count"), 6).alias("mean_dest_prior_count"),
        F.max("dest_prior_count").alias("max_dest_prior_count"),
        F.max("orig_prior_count").alias("max_orig_prior_count"),
    )


def matrix_features() -> list[str]:
    """Candidate feature names in table order (same rule as `candidate_features`)."""
    drop = set(S.DROP_FOR_FEATURES) | {S.LABEL}
    text = {"nameOrig", "nameDest", "type", "home_billing_country", "ip_country", "home_device_id", "device_id", "browser_fingerprint"}
    numeric_base = [c for c in S.ENRICHED_COLUMNS if c not in drop and c not in text]
    return numeric_base + [c for c in FE.DERIVED_ORDER if c not in drop]


def matrix_cte(name: str = "fm") -> str:
    """DuckDB CTE of the unrounded feature matrix over the universe."""
    exprs = {**ROW_SQL, **_vel_sql("nameDest", "dest"), **_vel_sql("nameOrig", "orig"), **ONE_HOT_SQL}
    inner = "SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in exprs.items()) + " FROM transactions"
    cols = ["txn_id"] + matrix_features() + ["isFraud", "amount AS amount_raw", "step AS step_raw"]
    return f"{name} AS (SELECT {', '.join(cols)} FROM ({inner}) WHERE type IN ('TRANSFER','CASH_OUT'))"


def _matrix_sql() -> str:
    cols = ["txn_id"] + [_r(c, c) for c in matrix_features()] + ["isFraud", "round(amount_raw, 6) AS amount_raw", "step_raw"]
    return txn_sql(f"SELECT {', '.join(cols)} FROM fm", ctes=matrix_cte())


@query("feature_matrix", _matrix_sql())
def feature_matrix(spark, sf):
    """FE22/FE24: 48 candidate features + label + audit columns over the universe."""
    m, _ = FE.feature_matrix(transactions(spark, sf))
    return round_doubles(m)


OLD_NEW_COLS = ["errorBalanceOrig", "errorBalanceDest", "origin_emptied", "amount_to_oldbalanceOrg", "log_amount",
                "ip_country_mismatch", "orig_prior_txn_count", "orig_time_since_last", "is_first_orig_txn",
                "dest_prior_txn_count", "dest_prior_amount_sum"]


def older_variant(spark, sf):
    """Older feature variant: ln(1+amount), error columns, origin and destination velocity."""
    t = transactions(spark, sf)
    f = FE.row_features(t, log_amount="ln1p").withColumnsRenamed(
        {"orig_balance_err": "errorBalanceOrig", "dest_balance_err": "errorBalanceDest"})
    f = FE.causal_velocity(f, "nameOrig", "orig", names={
        "prior_count": "orig_prior_txn_count", "steps_since_last": "orig_time_since_last", "first_seen": "is_first_orig_txn"})
    return FE.dest_prior_amount(f)


def _older_sql() -> str:
    w_o = "(PARTITION BY nameOrig ORDER BY step, txn_id)"
    return f"""older AS (SELECT *, oldbalanceOrg - amount - newbalanceOrig AS errorBalanceOrig,
       oldbalanceDest + amount - newbalanceDest AS errorBalanceDest, {ROW_SQL['origin_emptied']} AS origin_emptied,
       amount / (oldbalanceOrg + 1.0) AS amount_to_oldbalanceOrg, ln(1 + amount) AS log_amount,
       {ROW_SQL['ip_country_mismatch']} AS ip_country_mismatch,
       row_number() OVER {w_o} - 1 AS orig_prior_txn_count,
       coalesce(CAST(step - lag(step) OVER {w_o} AS DOUBLE), -1.0) AS orig_time_since_last,
       CAST(lag(step) OVER {w_o} IS NULL AS INTEGER) AS is_first_orig_txn,
       row_number() OVER {_PA_W} - 1 AS dest_prior_txn_count,
       coalesce(sum(amount) OVER (PARTITION BY nameDest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS dest_prior_amount_sum
FROM transactions)"""


@query("feature_describe", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM older" for c in OLD_NEW_COLS),
    ctes=_older_sql()))
def feature_describe(spark, sf):
    """Mean, std, min, max of the older variant's engineered columns."""
    return X.feature_describe(older_variant(spark, sf), OLD_NEW_COLS)


CORR16 = ["amount", "log_amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "errorBalanceOrig",
          "errorBalanceDest", "origin_emptied", "account_age_days", "is_new_device", "shipping_billing_mismatch",
          "failed_payment_attempts", "ip_billing_distance_km", "is_night"]


@query("feature_label_corr", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(isFraud AS DOUBLE)), 6) AS corr_with_isFraud, "
    f"round(abs(corr(CAST({c} AS DOUBLE), CAST(isFraud AS DOUBLE))), 6) AS abs_corr FROM older" for c in CORR16), ctes=_older_sql()))
def feature_label_corr(spark, sf):
    """Correlation of 15 numeric columns with the label, with |corr| for ranking."""
    return X.label_corr(older_variant(spark, sf), CORR16)
