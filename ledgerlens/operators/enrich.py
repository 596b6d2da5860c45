"""Account roll-up, profile join and context derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCOUNT_FIELDS = ["account_age_days", "home_billing_country", "home_device_id"]


def account_profiles(df: DataFrame) -> DataFrame:
    """One row per origin account: ever-fraud flag and its account-level fields.

    Output is hash-partitioned on nameOrig by the aggregate, which the join in
    `join_profiles` reuses. Accounts are nearly as many as transactions, so the
    profile is never broadcast.
    """
    return df.groupBy("nameOrig").agg(
        F.max("isFraud").alias("account_ever_fraud"),
        *[F.min(c).alias(c) for c in ACCOUNT_FIELDS if c in df.columns],
    )


def join_profiles(base: DataFrame, profiles: DataFrame) -> DataFrame:
    """Many-to-one left equi-join of profiles onto transactions on nameOrig.

    Sort-merge join chosen by the planner (AQE may switch strategy at run time
    and splits a skewed hot account with its skew-join rule).
    """
    return base.join(profiles, "nameOrig", "left")


def hour_and_night(step: str | Column = "step") -> dict[str, Column]:
    """hour_of_day = step mod 24, is_night = hour in 0..5."""
    s = F.col(step) if isinstance(step, str) else step
    hour = F.pmod(s, F.lit(24)).cast("int")
    return {"hour_of_day": hour, "is_night": hour.between(0, 5).cast("int")}


def fingerprint(device: str | Column = "device_id") -> Column:
    """E3: 'fp_' + first 10 hex digits of md5(device id)."""
    d = F.col(device) if isinstance(device, str) else device
    return F.concat(F.lit("fp_"), F.substring(F.md5(d), 1, 10))


def effective_device(is_new: str, new_id: str | Column, home_id: str) -> Column:
    """The home device unless the transaction used a new one."""
    n = F.col(new_id) if isinstance(new_id, str) else new_id
    return F.when(F.col(is_new) == 1, n).otherwise(F.col(home_id))


def device_id_of(n: Column) -> Column:
    """E5: device id formatted as 'dev_%08x' from a non-negative integer."""
    return F.format_string("dev_%08x", n.cast("long"))


def distance_regime(ip: str, home: str, domestic: Column, foreign: Column) -> Column:
    """Same country -> domestic distance, else foreign distance + 300 km; 1 dp."""
    return F.round(F.when(F.col(ip) == F.col(home), domestic).otherwise(foreign + F.lit(300.0)), 1)
