"""Table schemas and the fixed vocabularies of the transaction domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the domain definition) -----------------------
# Transaction types, and the two in which fraud occurs (the "universe").
ALL_TYPES = ["TRANSFER", "CASH_OUT", "PAYMENT", "DEBIT", "CASH_IN"]
FRAUD_TYPES = ["TRANSFER", "CASH_OUT"]
# Country vocabulary for billing / IP country.
COUNTRIES = ["US", "GB", "DE", "FR", "IN", "BR", "NG", "RU", "CN", "VN"]
# Step horizon of the base data (1 step = 1 hour) and the default for live rows.
MIN_STEP, MAX_STEP, DEFAULT_STEP = 1, 743, 744
UNKNOWN_DEST = "UNKNOWN_DEST"
# Reference / current split point and rolling window used by monitoring.
REFERENCE_MAX_STEP = 354
ROLLING_WINDOW_STEPS = 168
# Cost model: a false positive costs C_FP, a missed fraud its amount.
C_FP = 10.0
MIN_OPERATING_THRESHOLD = 0.0005
# Soft ceiling on IP-to-billing distance (rows above it are kept, counted).
DISTANCE_SOFT_CEILING_KM = 23000.0
# --------------------------------------------------------------------------

BASE_COLUMNS = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
]

CONTEXT_COLUMNS = [
    "account_age_days", "home_billing_country", "home_device_id", "device_id",
    "is_new_device", "browser_fingerprint", "shipping_billing_mismatch",
    "failed_payment_attempts", "ip_country", "ip_billing_distance_km",
    "hour_of_day", "is_night",
]

ENRICHED_COLUMNS = BASE_COLUMNS + CONTEXT_COLUMNS

BASE_SCHEMA = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

CONTEXT_SCHEMA = T.StructType([
    T.StructField("account_age_days", T.LongType()),
    T.StructField("home_billing_country", T.StringType()),
    T.StructField("home_device_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("is_new_device", T.IntegerType()),
    T.StructField("browser_fingerprint", T.StringType()),
    T.StructField("shipping_billing_mismatch", T.IntegerType()),
    T.StructField("failed_payment_attempts", T.LongType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("ip_billing_distance_km", T.DoubleType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("is_night", T.IntegerType()),
])

ENRICHED_SCHEMA = T.StructType(BASE_SCHEMA.fields + CONTEXT_SCHEMA.fields)

# Scored-event record of the scoring service (JSON lines).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_time_utc", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("account_age_days", T.StringType()),
    T.StructField("is_new_device", T.StringType()),
    T.StructField("shipping_billing_mismatch", T.StringType()),
    T.StructField("failed_payment_attempts", T.StringType()),
    T.StructField("ip_billing_distance_km", T.StringType()),
    T.StructField("home_billing_country", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("hour_of_day", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("dest_prior_count", T.StringType()),
    T.StructField("dest_steps_since_last", T.StringType()),
    T.StructField("oldbalanceOrg", T.StringType()),
    T.StructField("newbalanceOrig", T.StringType()),
    T.StructField("oldbalanceDest", T.StringType()),
    T.StructField("newbalanceDest", T.StringType()),
    T.StructField("actual_label", T.StringType()),
    T.StructField("fraud_probability", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("threshold", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("latency_ms", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

# Continuous columns scaled by the robust scaler (order fixed).
CONTINUOUS_FEATURES = [
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "account_age_days", "failed_payment_attempts", "ip_billing_distance_km",
    "log_amount", "orig_balance_err", "dest_balance_err", "amount_to_oldbalanceOrg",
    "log_ip_distance", "dest_prior_count", "dest_steps_since_last",
    "hour_sin", "hour_cos", "step",
]

# Columns dropped before feature assembly (ids, raw categoricals, leakage).
DROP_FOR_FEATURES = [
    "nameOrig", "nameDest", "device_id", "home_device_id", "browser_fingerprint",
    "isFlaggedFraud", "type", "home_billing_country", "ip_country", "hour_of_day",
    "orig_prior_count",
]

# Balance / amount ("mechanical") columns removed from the behavioural set.
MECHANICAL_FEATURES = [
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "log_amount", "orig_balance_err", "dest_balance_err", "drained_origin",
    "amount_to_oldbalanceOrg", "dest_balances_masked",
]

LABEL = "isFraud"
