"""`transactions` stand-in view over the driver's `events` table.

The driver's test data has no payment table, so this view gives rows in the
enriched transaction schema (plus `txn_id` and an evaluation-only `score`)
from `events`. It does none of any query's work: every operator reads it as
an ordinary DataFrame and must be right on any data of this schema.

`u(tag, key)` is a uniform draw in [0, 1) taken from the first 8 hex digits of
md5(tag || ':' || key). The Spark and DuckDB forms below are the same rules
(FIXTURES.md §B1), so the SQL oracle sees the very same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# fixed values: event_type -> transaction type
TYPE_OF_EVENT = {
    "purchase": "TRANSFER",
    "click": "CASH_OUT",
    "view": "PAYMENT",
    "signup": "CASH_IN",
    "error": "DEBIT",
}
# fixed values: cumulative home-country weights in COUNTRIES order
HOME_CUMULATIVE = [
    ("US", 0.30), ("GB", 0.45), ("DE", 0.57), ("FR", 0.67), ("IN", 0.77),
    ("BR", 0.84), ("NG", 0.90), ("RU", 0.94), ("CN", 0.97), ("VN", 1.0),
]


# draws keyed by the event id
EVENT_DRAWS = ["fraud", "flag", "ob", "od", "ndst", "ipc", "ipf", "dist", "age1", "age2", "dev", "shp", "f1", "f2", "noise"]


def _draw(tag: Column, key: Column) -> Column:
    h = F.md5(F.concat(tag, F.lit(":"), key))
    # by way of a long: reading a double from text costs more than the rest of a draw
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def _u(tag: str, key: Column) -> Column:
    return _draw(F.lit(tag), key.cast("string"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Map `events` rows to the 23-column enriched schema + txn_id + score."""
    e = F.col("event_id")
    # all draws of a row in one array: written out one by one they make a generated method too long to be compiled
    key = e.cast("string")
    draws = F.transform(F.array(*[F.lit(tag) for tag in EVENT_DRAWS]), lambda tag: _draw(tag, key))
    u = lambda tag: F.col("_u")[EVENT_DRAWS.index(tag)]
    type_col = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in TYPE_OF_EVENT.items()])
    df = events.select(
        e.alias("txn_id"),
        (F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") + 1).cast("long").alias("step"),
        type_col.alias("type"),
        F.col("value").alias("amount"),
        F.concat(F.lit("C"), F.when((e % 500 == 0) & (e > 0), e - 1).otherwise(e).cast("string")).alias("nameOrig"),
        F.col("user_id"),
        e.alias("_e"),
        draws.alias("_u"),
    )
    is_pay = F.col("type") == "PAYMENT"
    df = df.withColumn("nameDest", F.concat(F.when(is_pay, F.lit("M")).otherwise(F.lit("C")), F.col("user_id").cast("string")))
    df = df.withColumn(
        "isFraud",
        (F.col("type").isin("TRANSFER", "CASH_OUT") & (u("fraud") < 0.03)).cast("int"),
    )
    fraud = F.col("isFraud") == 1
    df = df.withColumn("isFlaggedFraud", (fraud & (u("flag") < 0.01)).cast("int"))
    df = df.withColumn(
        "oldbalanceOrg",
        F.when(fraud, F.col("amount")).otherwise(F.col("amount") * F.floor(F.lit(8.0) * u("ob")).cast("double")),
    )
    df = df.withColumn("newbalanceOrig", F.greatest(F.col("oldbalanceOrg") - F.col("amount"), F.lit(0.0)))
    df = df.withColumn(
        "oldbalanceDest",
        F.when(is_pay, F.lit(0.0)).otherwise(F.col("amount") * F.floor(F.lit(5.0) * u("od")).cast("double")),
    )
    df = df.withColumn(
        "newbalanceDest",
        F.when(is_pay, F.lit(0.0))
        .when(u("ndst") < 0.3, F.col("oldbalanceDest"))
        .otherwise(F.col("oldbalanceDest") + F.col("amount")),
    )
    # a column of its own: the ten comparisons read it, they do not draw again
    df = df.withColumn("_uh", _u("home", F.col("nameOrig")))
    uh = F.col("_uh")
    home = F.coalesce(*[F.when(uh < w, F.lit(c)) for c, w in HOME_CUMULATIVE])
    df = df.withColumn("home_billing_country", home)
    ipc = F.element_at(F.array(*[F.lit(c) for c, _ in HOME_CUMULATIVE]), (F.floor(F.lit(10.0) * u("ipc")) + 1).cast("int"))
    df = df.withColumn(
        "ip_country",
        F.when(u("ipf") < F.when(fraud, F.lit(0.6)).otherwise(F.lit(0.07)), ipc).otherwise(F.col("home_billing_country")),
    )
    ud = u("dist")
    df = df.withColumn(
        "ip_billing_distance_km",
        F.when(F.col("ip_country") == F.col("home_billing_country"), F.floor(F.lit(2400.0) * ud) / F.lit(10.0))
        .otherwise(F.lit(300.0) + F.floor(F.lit(50000.0) * ud) / F.lit(10.0)),
    )
    df = df.withColumn(
        "account_age_days",
        (F.lit(1) + F.floor(F.lit(1500.0) * u("age1") * u("age2")
                            * F.when(fraud, F.lit(0.5)).otherwise(F.lit(1.0)))).cast("long"),
    )
    df = df.withColumn("is_new_device", (u("dev") < F.when(fraud, F.lit(0.7)).otherwise(F.lit(0.08))).cast("int"))
    df = df.withColumn(
        "shipping_billing_mismatch",
        (u("shp") < F.when(fraud, F.lit(0.55)).otherwise(F.lit(0.10))).cast("int"),
    )
    df = df.withColumn(
        "failed_payment_attempts",
        F.floor(u("f1") * u("f2") * F.when(fraud, F.lit(8.0)).otherwise(F.lit(2.0))).cast("long"),
    )
    df = df.withColumn("home_device_id", F.concat(F.lit("dev_"), F.substring(F.md5(F.concat(F.lit("home:"), F.col("nameOrig"))), 1, 8)))
    df = df.withColumn(
        "device_id",
        F.when(F.col("is_new_device") == 1,
               F.concat(F.lit("dev_"), F.substring(F.md5(F.concat(F.lit("new:"), F.col("_e").cast("string"))), 1, 8)))
        .otherwise(F.col("home_device_id")),
    )
    df = df.withColumn("browser_fingerprint", F.concat(F.lit("fp_"), F.substring(F.md5(F.col("device_id")), 1, 10)))
    df = df.withColumn("hour_of_day", F.pmod(F.col("step"), F.lit(24)).cast("int"))
    df = df.withColumn("is_night", (F.col("hour_of_day") <= 5).cast("int"))
    pts = (
        F.lit(35) * F.col("is_new_device") + F.lit(20) * F.col("shipping_billing_mismatch")
        + F.lit(25) * (F.col("ip_country") != F.col("home_billing_country")).cast("int")
        + F.lit(15) * (F.col("failed_payment_attempts") >= 3).cast("int") + F.lit(5) * F.col("is_night")
    )
    df = df.withColumn(
        "score",
        F.floor(F.lit(10000.0) * (F.lit(0.009) * pts.cast("double") + F.lit(0.1) * u("noise"))) / F.lit(10000.0),
    )
    return df.select(
        "txn_id", "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
        "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud", "account_age_days",
        "home_billing_country", "home_device_id", "device_id", "is_new_device", "browser_fingerprint",
        "shipping_billing_mismatch", "failed_payment_attempts", "ip_country", "ip_billing_distance_km",
        "hour_of_day", "is_night", "score",
    )


# Rows that one task maps. Events are stored small and take long: by bytes alone a task would get millions of rows.
ROWS_PER_TASK = 200_000
# Tables too small for as many tasks as there are cores are still dealt to them in parts of so many rows.
MIN_ROWS_PER_TASK = 25_000


def map_tasks(rows: int, cores: int) -> int:
    """Tasks that map so many rows."""
    return max(1, -(-rows // ROWS_PER_TASK), min(cores, -(-rows // MIN_ROWS_PER_TASK)))


def spread(events: DataFrame) -> DataFrame:
    """The same rows, dealt evenly to tasks by their number, whatever files and row groups they come from."""
    tasks = map_tasks(events.count(), events.sparkSession.sparkContext.defaultParallelism)
    return events.repartition(tasks) if tasks > 1 else events


_MATERIALISED: dict[tuple[str, str], str] = {}


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in `transactions` table for an sf folder.

    Written once per session as parquet under the session's checkpoint folder
    (a shared folder on a cluster) and read back as a table, so every query
    scans real columnar data with pruning and pushdown instead of re-deriving
    the view.
    """
    import uuid

    from ..session import checkpoint_dir

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _MATERIALISED.get(key)
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/transactions-{uuid.uuid4().hex}"
        transactions_from_events(spread(read_table(spark, sf_dir, "events"))).write.mode("overwrite").parquet(path)
        _MATERIALISED[key] = path
    return spark.read.parquet(path)


def _du(tag: str, key: str) -> str:
    return f"(('0x'||substr(md5('{tag}:'||CAST({key} AS VARCHAR)),1,8))::BIGINT::DOUBLE/4294967296.0::DOUBLE)"


def _type_case() -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_OF_EVENT.items())
    return f"CASE event_type {arms} END"


def _home_case() -> str:
    arms = " ".join(f"WHEN {_du('home', 'nameOrig')} < {w}::DOUBLE THEN '{c}'" for c, w in HOME_CUMULATIVE)
    return f"CASE {arms} END"


def _ip_pick() -> str:
    arms = " ".join(f"WHEN {i} THEN '{c}'" for i, (c, _) in enumerate(HOME_CUMULATIVE))
    return f"CASE CAST(floor(10.0::DOUBLE*{_du('ipc', '_e')}) AS INTEGER) {arms} END"


# DuckDB form of the same view; oracle queries start with `WITH {TXN_CTE}`.
TXN_CTE = f"""
_t0 AS (
  SELECT event_id AS txn_id, event_id AS _e, user_id,
         CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS BIGINT) AS step,
         {_type_case()} AS type,
         value AS amount,
         'C' || CAST(CASE WHEN event_id % 500 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS nameOrig
  FROM events),
_t1 AS (
  SELECT *, (CASE WHEN type = 'PAYMENT' THEN 'M' ELSE 'C' END) || CAST(user_id AS VARCHAR) AS nameDest,
         CAST(type IN ('TRANSFER','CASH_OUT') AND {_du('fraud', '_e')} < 0.03::DOUBLE AS INTEGER) AS isFraud
  FROM _t0),
_t2 AS (
  SELECT *, CAST(isFraud = 1 AND {_du('flag', '_e')} < 0.01::DOUBLE AS INTEGER) AS isFlaggedFraud,
         CASE WHEN isFraud = 1 THEN amount ELSE amount * CAST(floor(8.0::DOUBLE * {_du('ob', '_e')}) AS DOUBLE) END AS oldbalanceOrg,
         CASE WHEN type = 'PAYMENT' THEN 0.0::DOUBLE ELSE amount * CAST(floor(5.0::DOUBLE * {_du('od', '_e')}) AS DOUBLE) END AS oldbalanceDest,
         {_home_case()} AS home_billing_country
  FROM _t1),
_t3 AS (
  SELECT *, greatest(oldbalanceOrg - amount, 0.0::DOUBLE) AS newbalanceOrig,
         CASE WHEN type = 'PAYMENT' THEN 0.0::DOUBLE WHEN {_du('ndst', '_e')} < 0.3::DOUBLE THEN oldbalanceDest
              ELSE oldbalanceDest + amount END AS newbalanceDest,
         CASE WHEN {_du('ipf', '_e')} < (CASE WHEN isFraud = 1 THEN 0.6::DOUBLE ELSE 0.07::DOUBLE END) THEN {_ip_pick()}
              ELSE home_billing_country END AS ip_country,
         CAST(1 + floor(1500.0::DOUBLE * {_du('age1', '_e')} * {_du('age2', '_e')}
              * (CASE WHEN isFraud = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)) AS BIGINT) AS account_age_days,
         CAST({_du('dev', '_e')} < (CASE WHEN isFraud = 1 THEN 0.7::DOUBLE ELSE 0.08::DOUBLE END) AS INTEGER) AS is_new_device,
         CAST({_du('shp', '_e')} < (CASE WHEN isFraud = 1 THEN 0.55::DOUBLE ELSE 0.10::DOUBLE END) AS INTEGER) AS shipping_billing_mismatch,
         CAST(floor({_du('f1', '_e')} * {_du('f2', '_e')} * (CASE WHEN isFraud = 1 THEN 8.0::DOUBLE ELSE 2.0::DOUBLE END)) AS BIGINT) AS failed_payment_attempts,
         'dev_' || substr(md5('home:' || nameOrig), 1, 8) AS home_device_id,
         CAST(step % 24 AS INTEGER) AS hour_of_day
  FROM _t2),
_t4 AS (
  SELECT *,
         CASE WHEN ip_country = home_billing_country THEN floor(2400.0::DOUBLE * {_du('dist', '_e')}) / 10.0::DOUBLE
              ELSE 300.0::DOUBLE + floor(50000.0::DOUBLE * {_du('dist', '_e')}) / 10.0::DOUBLE END AS ip_billing_distance_km,
         CASE WHEN is_new_device = 1 THEN 'dev_' || substr(md5('new:' || CAST(_e AS VARCHAR)), 1, 8) ELSE home_device_id END AS device_id,
         CAST(hour_of_day <= 5 AS INTEGER) AS is_night
  FROM _t3),
transactions AS (
  SELECT txn_id, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest,
         isFraud, isFlaggedFraud, account_age_days, home_billing_country, home_device_id, device_id, is_new_device,
         'fp_' || substr(md5(device_id), 1, 10) AS browser_fingerprint, shipping_billing_mismatch, failed_payment_attempts,
         ip_country, ip_billing_distance_km, hour_of_day, is_night,
         floor(10000.0::DOUBLE * (0.009::DOUBLE * CAST(35 * is_new_device + 20 * shipping_billing_mismatch
               + 25 * CAST(ip_country <> home_billing_country AS INTEGER) + 15 * CAST(failed_payment_attempts >= 3 AS INTEGER)
               + 5 * is_night AS DOUBLE) + 0.1::DOUBLE * {_du('noise', '_e')})) / 10000.0::DOUBLE AS score
  FROM _t4)
"""
