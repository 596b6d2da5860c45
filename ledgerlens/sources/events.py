"""Scored-event log: JSON-lines sink and tolerant source (S7, S8, S13, S14, Q28, MN2).

The log is append-only JSON lines written by the scorer. Reading is tolerant:
blank lines are skipped, malformed lines are dropped and counted, fields are
read as text with an explicit schema and coerced with `try_cast`, so one bad
record never fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import flag
from .fixture import _du, _u

EVENT_FIELDS = [f.name for f in S.EVENT_SCHEMA.fields if f.name != "_corrupt_record"]
OPTIONAL_FIELDS = ["step", "hour_of_day", "nameDest", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]


def event_records(scored: DataFrame, source: str = "batch", model: str = "score") -> DataFrame:
    """P10: the scored-event record of each scored request (typed columns)."""
    ts = F.expr("timestampadd(HOUR, step - 1, TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    return scored.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time_utc"),
        F.lit(source).alias("source"),
        F.concat(F.lit("txn_"), F.col("txn_id").cast("string")).alias("transaction_id"),
        "type", "amount", "account_age_days",
        (F.col("is_new_device") == 1).alias("is_new_device"),
        (F.col("shipping_billing_mismatch") == 1).alias("shipping_billing_mismatch"),
        "failed_payment_attempts", "ip_billing_distance_km", "home_billing_country", "ip_country",
        "step", "hour_of_day", "nameDest", "dest_prior_count", "dest_steps_since_last",
        "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
        F.col("isFraud").alias("actual_label"), "fraud_probability", "decision", "threshold",
        F.when(F.col("fraud_probability").isNotNull(), F.lit(model)).alias("model"),
        F.lit(None).cast("double").alias("latency_ms"),
        F.col("txn_id"),
    )


def write_event_log(records: DataFrame, path: str) -> None:
    """Append scored events as JSON lines (nulls omitted, like optional keys)."""
    records.drop("txn_id").write.mode("append").json(path)


def stand_in_lines(records: DataFrame) -> DataFrame:
    """Stand-in log text for tests and registered queries, built from scored records.

    It only shapes input the way a real log looks: ~10 % of events omit the
    optional fields, ~5 % carry no label, ~2 % of lines are cut mid-record and
    ~1 % are blank (rules keyed on md5 of the id, so SQL can name the same rows).
    """
    e = F.col("txn_id")
    rec = records.withColumns({"__opt_off": _u("opt", e) < 0.1, "__lab_on": _u("lab", e) >= 0.05,
                               "__blank": _u("blank", e) < 0.01, "__junk": _u("junk", e) < 0.02})
    rec = rec.withColumns({c: F.when(~F.col("__opt_off"), F.col(c)) for c in OPTIONAL_FIELDS})
    rec = rec.withColumn("actual_label", F.when(F.col("__lab_on"), F.col("actual_label")))
    rec = rec.withColumn("__js", F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS])))
    js = F.col("__js")
    line = (F.when(F.col("__blank"), F.lit(""))
            .when(F.col("__junk"), F.substring(js, 1, (F.length(js) / 2).cast("int")))
            .otherwise(js))
    return rec.select(line.alias("value"))


def stand_in_sql(prefix: str = "") -> dict[str, str]:
    """The same stand-in rules as DuckDB predicates over `txn_id`."""
    return {
        "blank": f"{_du('blank', prefix + 'txn_id')} < 0.01::DOUBLE",
        "junk": f"{_du('junk', prefix + 'txn_id')} < 0.02::DOUBLE",
        "opt_off": f"{_du('opt', prefix + 'txn_id')} < 0.1::DOUBLE",
        "no_label": f"{_du('lab', prefix + 'txn_id')} >= 0.05::DOUBLE",
    }


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """S7 over a column of text lines: blank flag, parsed struct, corrupt flag."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    blank = ~F.col(col).rlike(r"\S")
    j = F.from_json(F.col(col), S.EVENT_SCHEMA, opts)
    return lines.select(blank.alias("__blank"), j.alias("e")).select("__blank", "e.*")


def tolerant_summary(parsed: DataFrame) -> DataFrame:
    """S7 report: lines, blank lines skipped, malformed lines dropped, events parsed."""
    bad = ~F.col("__blank") & F.col("_corrupt_record").isNotNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("__blank").cast("int")).cast("long").alias("blank_lines"),
        F.sum(bad.cast("int")).cast("long").alias("malformed_lines"),
        F.sum((~F.col("__blank") & F.col("_corrupt_record").isNull()).cast("int")).cast("long").alias("parsed_events"),
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("__blank") & F.col("_corrupt_record").isNull()).drop("__blank", "_corrupt_record")


def read_event_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S7 over files: (good events, one-row summary of lines / blank / malformed / parsed).

    The log is read as text and parsed with the same tolerant `from_json` as
    `parse_lines`, so blank and malformed lines are counted in one pass.
    """
    parsed = parse_lines(spark.read.text(path))
    return good_events(parsed), tolerant_summary(parsed)


def count_logged_events(spark: SparkSession, path: str) -> int:
    """Number of non-blank lines in the log."""
    return spark.read.text(path).where(F.col("value").rlike(r"\S")).count()


def _num(c: str, t: str = "double") -> Column:
    return F.col(c).try_cast(t)


def _flag(c: str) -> Column:
    v = F.lower(F.trim(F.col(c)))
    return F.coalesce(F.when(v == "true", 1).when(v == "false", 0).otherwise(v.try_cast("int")), F.lit(0)).cast("int")


def fill_missing_scores(frame: DataFrame, model_scores: DataFrame, id_col: str = "transaction_id",
                        proba: str = "proba") -> DataFrame:
    """MN2: keep the logged probability; use a model's probability only where none was logged.

    `model_scores` holds (transaction_id, proba) for the events the model scored.
    """
    m = model_scores.select(id_col, F.col(proba).alias("__model_p"))
    return (frame.join(m, id_col, "left")
            .withColumn("prediction_proba", F.coalesce(F.col("prediction_proba"), F.col("__model_p")))
            .drop("__model_p"))


def event_frame(events: DataFrame) -> DataFrame:
    """Q28 + MN2: typed, defaulted universe events ready for features and monitoring.

    step -> 744 when missing or unparseable, hour -> step mod 24, dest ->
    UNKNOWN_DEST, balances -> 0, flags -> 0, label from `actual_label`; the
    logged probability is kept; prediction = decision in (REVIEW, BLOCK).
    """
    e = events.where(F.col("type").isin(S.FRAUD_TYPES))
    step = F.coalesce(_num("step", "long"), F.lit(S.DEFAULT_STEP).cast("long"))
    e = e.withColumn("step", step)
    hour = F.coalesce(_num("hour_of_day", "int"), F.pmod(F.col("step"), F.lit(24)).cast("int"))
    return e.select(
        "transaction_id", "type", "step",
        hour.alias("hour_of_day"), hour.between(0, 5).cast("int").alias("is_night"),
        F.coalesce(F.col("nameDest"), F.lit(S.UNKNOWN_DEST)).alias("nameDest"),
        *[F.coalesce(_num(c), F.lit(0.0)).alias(c) for c in ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")],
        _num("amount").alias("amount"), _num("account_age_days", "long").alias("account_age_days"),
        _num("failed_payment_attempts", "long").alias("failed_payment_attempts"),
        _num("ip_billing_distance_km").alias("ip_billing_distance_km"),
        _flag("is_new_device").alias("is_new_device"), _flag("shipping_billing_mismatch").alias("shipping_billing_mismatch"),
        "home_billing_country", "ip_country",
        # numeric coercion of the logged label (double, NULL when unlabelled or unparseable)
        _num("actual_label", "double").alias("isFraud"),
        _num("fraud_probability").alias("prediction_proba"),
        flag(F.col("decision").isin("REVIEW", "BLOCK")).alias("prediction"),
    )
