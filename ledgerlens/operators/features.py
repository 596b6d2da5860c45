"""Feature engineering (FE1-FE25): one module for batch, stream and monitoring.

Row-wise features are plain projections (whole-stage codegen). Causal velocity
features are per-key windows in the total order (step, txn_id); a hot key
(say a merchant receiving a third of all rows) is split off and ranked with
the distributed position recipe of `ranks`, so no task ever sorts a whole
hot key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import flag, isclose, safe_div
from ..session import conf_int
from . import ranks

# Keys with more rows than this are ranked by the split (hot-key) path.
HOT_KEY_ROWS = 5_000_000


def row_features(df: DataFrame, log_amount: str = "log10") -> DataFrame:
    """FE1-FE11, FE18, FE19 (FE5 origin_emptied from the older variant too)."""
    amt, old_o, new_o = F.col("amount"), F.col("oldbalanceOrg"), F.col("newbalanceOrig")
    old_d, new_d = F.col("oldbalanceDest"), F.col("newbalanceDest")
    hour = F.col("hour_of_day").cast("double")
    la = F.log10(amt + F.lit(1.0)) if log_amount == "log10" else F.log1p(amt)
    return df.withColumns({
        "log_amount": la,
        "orig_balance_err": old_o - amt - new_o,
        "dest_balance_err": old_d + amt - new_d,
        "drained_origin": flag((new_o == 0) & (old_o > 0)),
        "origin_emptied": flag((new_o == 0) & isclose(old_o, amt)),
        # a balance of -1 has no ratio (NULL), it must not end the job
        "amount_to_oldbalanceOrg": safe_div(amt, old_o + F.lit(1.0)),
        "dest_balances_masked": flag((old_d == 0) & (new_d == 0)),
        # pandas `!=` is True when either side is missing
        "ip_country_mismatch": F.coalesce(F.col("ip_country") != F.col("home_billing_country"), F.lit(True)).cast("int"),
        "log_ip_distance": F.log10(F.col("ip_billing_distance_km") + F.lit(1.0)),
        "young_account": flag(F.col("account_age_days") <= 90),
        "high_failed_attempts": flag(F.col("failed_payment_attempts") >= 3),
        "hour_sin": F.sin(F.lit(2 * math.pi) * hour / F.lit(24.0)),
        "hour_cos": F.cos(F.lit(2 * math.pi) * hour / F.lit(24.0)),
        "is_transfer": flag(F.col("type") == "TRANSFER"),
    })


def _hot_keys(df: DataFrame, key: str, threshold: int) -> DataFrame | None:
    """Keys (NULL too) with more than `threshold` rows, as a written table; None if there is none.

    The keys never reach the driver: they are written once to the session's
    shared folder, and Spark decides by their size how to join them.
    """
    from ..session import stored

    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    # one number first: most tables have no hot key, and nothing is written for them
    if (counts.agg(F.max("__n")).first()[0] or 0) <= threshold:
        return None
    return stored(counts.where(F.col("__n") > threshold).select(F.col(key).alias("__hot")), "hot-keys")


def causal_velocity(
    df: DataFrame,
    key: str,
    prefix: str,
    order_col: str = "step",
    id_col: str = "txn_id",
    amount_col: str | None = None,
    hot_threshold: int | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Per-key causal counters in (order_col, id_col) order.

    Adds `{prefix}_prior_count` (earlier rows of the key), `{prefix}_steps_since_last`
    (gap to the previous row of the key, -1 if none), `{prefix}_first_seen`, and
    with `amount_col` the running `{prefix}_prior_amount_sum` (amount before this row).
    `names` renames outputs (e.g. the older variant's column names).
    """
    names = names or {}
    pc = names.get("prior_count", f"{prefix}_prior_count")
    ssl = names.get("steps_since_last", f"{prefix}_steps_since_last")
    fs = names.get("first_seen", f"{prefix}_first_seen")
    pas = names.get("prior_amount_sum", f"{prefix}_prior_amount_sum")
    threshold = (conf_int(df.sparkSession, "spark.ledgerlens.velocity.hotKeyRows", HOT_KEY_ROWS)
                 if hot_threshold is None else hot_threshold)
    hot = _hot_keys(df, key, threshold)

    def cold_path(x: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(order_col, id_col)  # NULL steps first, as in the hot path
        cols = {
            pc: (F.row_number().over(w) - 1).cast("long"),
            "__prev": F.lag(order_col).over(w),
        }
        if amount_col:
            cols[pas] = F.coalesce(F.sum(amount_col).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        return x.withColumns(cols)

    def hot_path(x: DataFrame) -> DataFrame:
        pos = ranks.row_positions(x, [key], order_col, id_col, out=pc, sums={amount_col: pas} if amount_col else None)
        # distinct (key, step) cells: rows before each step and the previous step
        cells = x.groupBy(key, order_col).agg(F.count(F.lit(1)).alias("__c"))
        cells = ranks.cumulative(cells, [key], [order_col], ["__c"], prefix="__before")
        wc = Window.partitionBy(key).orderBy(order_col)
        cells = cells.withColumn("__prev_step", F.lag(order_col).over(wc)).drop("__c")
        y = ranks.null_safe_join(pos, cells, [key, order_col])
        first_in_step = F.col(pc) == F.col("__before__c")
        y = y.withColumn("__prev", F.when(first_in_step, F.col("__prev_step")).otherwise(F.col(order_col)))
        return y.drop("__before__c", "__prev_step")

    if hot is None:
        out = cold_path(df)
    else:
        is_hot = F.col(key).eqNullSafe(F.col("__hot"))
        cold = cold_path(df.join(hot, is_hot, "left_anti"))
        hotr = hot_path(df.join(hot, is_hot, "left_semi"))
        out = cold.unionByName(hotr.select(*cold.columns))
    out = out.withColumns({
        ssl: F.coalesce((F.col(order_col) - F.col("__prev")).cast("double"), F.lit(-1.0)),
        fs: F.col("__prev").isNull().cast("int"),
    }).drop("__prev")
    if amount_col:
        out = out.withColumn(pas, F.col(pas).cast("double"))
    return out


def dest_velocity(df: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """FE12, FE14, FE15 on nameDest."""
    return causal_velocity(df, "nameDest", "dest", hot_threshold=hot_threshold)


def orig_velocity(df: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """FE13 + FE17 on nameOrig (older variant names for the gap and first flag)."""
    return causal_velocity(
        df, "nameOrig", "orig", hot_threshold=hot_threshold,
        names={"steps_since_last": "orig_time_since_last", "first_seen": "is_first_orig_txn"},
    )


def dest_prior_amount(df: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """FE16: cumulative amount received by nameDest before this row (+ prior count)."""
    return causal_velocity(
        df, "nameDest", "dest", amount_col="amount", hot_threshold=hot_threshold,
        names={"prior_count": "dest_prior_txn_count"},
    ).drop("dest_steps_since_last", "dest_first_seen")


SORTED_COUNTRIES = sorted(S.COUNTRIES)


def one_hot(df: DataFrame, with_type: bool = False) -> DataFrame:
    """FE20/FE21: fixed-vocabulary one-hot columns; unknown values give all zeros."""
    cols: dict[str, Column] = {}
    for prefix, c in (("home", "home_billing_country"), ("ip", "ip_country")):
        for v in SORTED_COUNTRIES:
            cols[f"{prefix}_{v}"] = F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int")
    if with_type:
        for v in sorted(S.ALL_TYPES):
            cols[f"type_{v}"] = F.coalesce(F.col("type") == F.lit(v), F.lit(False)).cast("int")
    return df.withColumns(cols)


def candidate_features(df: DataFrame) -> list[str]:
    """FE22: numeric columns left after dropping ids, raw categoricals, leakage and the label."""
    from pyspark.sql.types import NumericType

    drop = set(S.DROP_FOR_FEATURES) | {S.LABEL, "txn_id", "score", "origin_emptied"}
    return [f.name for f in df.schema.fields if f.name not in drop and isinstance(f.dataType, NumericType)]


BEHAVIOURAL_BASE = [
    "step", "account_age_days", "is_new_device", "shipping_billing_mismatch", "failed_payment_attempts",
    "ip_billing_distance_km", "is_night", "ip_country_mismatch", "log_ip_distance", "young_account",
    "high_failed_attempts", "dest_prior_count", "dest_steps_since_last", "dest_first_seen",
    "hour_sin", "hour_cos", "is_transfer",
]


def behavioural(features: list[str]) -> list[str]:
    """FE23: remove the mechanical balance/amount columns from a feature list."""
    return [c for c in features if c not in S.MECHANICAL_FEATURES]


DERIVED_ORDER = [
    "log_amount", "orig_balance_err", "dest_balance_err", "drained_origin", "amount_to_oldbalanceOrg",
    "dest_balances_masked", "ip_country_mismatch", "log_ip_distance", "young_account", "high_failed_attempts",
    "dest_prior_count", "orig_prior_count", "dest_steps_since_last", "dest_first_seen", "hour_sin", "hour_cos",
    "is_transfer",
] + [f"{p}_{c}" for p in ("home", "ip") for c in SORTED_COUNTRIES]


def build_features(df: DataFrame, universe: list[str] = S.FRAUD_TYPES, scope_before_velocity: bool = False,
                   hot_threshold: int | None = None) -> DataFrame:
    """Training feature table: velocity over all types (unless scoped first), then the universe.

    Column order is the enriched columns then the derived features in their
    definition order (the order later selection steps depend on). Keeps txn_id
    and the audit columns amount_raw / step_raw (FE24).
    """
    x = df.where(F.col("type").isin(universe)) if scope_before_velocity else df
    x = dest_velocity(x, hot_threshold)
    x = orig_velocity(x, hot_threshold).drop("orig_time_since_last", "is_first_orig_txn")
    x = one_hot(row_features(x))
    if not scope_before_velocity:
        x = x.where(F.col("type").isin(universe))
    base = [c for c in df.columns if c not in DERIVED_ORDER]
    return x.select(*base, *DERIVED_ORDER).withColumns({"amount_raw": F.col("amount"), "step_raw": F.col("step")})


def feature_matrix(df: DataFrame, hot_threshold: int | None = None) -> tuple[DataFrame, list[str]]:
    """FE22 + FE24: id, candidate features, label and audit columns."""
    full = build_features(df, hot_threshold=hot_threshold)
    feats = [c for c in candidate_features(full) if c not in ("amount_raw", "step_raw")]
    return full.select("txn_id", *feats, S.LABEL, "amount_raw", "step_raw"), feats
