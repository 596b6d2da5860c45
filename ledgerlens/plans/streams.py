"""Structured Streaming queries (S12, P7, Q5, MN5): rows-only checks.

Each query writes its stand-in source files (derived from the test tables)
into a fresh folder under the session's checkpoint directory, runs the stream
with `availableNow`, and returns the sink table as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..sources import events as EV
from ..sources.fixture import transactions
from ..streaming import jobs as J
from ..streaming.velocity import stream_velocity as velocity_stream
from .registry import query, txn_sql
from ..streaming.scorer import score_stream
from .evaluate import test_threshold
from .score import SCORED_CTE, _R, scored

# stand-in arrival order: slices of the step horizon, one after another; the first and the last are open
ARRIVAL_ENDS = (180, 360, 540)


def _arrivals(df):
    """`df` cut by step into the slices in which it arrives; rows without a step come first."""
    cuts = [None, *ARRIVAL_ENDS, None]
    for lo, hi in zip(cuts, cuts[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("step") > lo)
        if hi is not None:
            low = F.col("step") <= hi
            cond = cond & (F.coalesce(low, F.lit(True)) if lo is None else low)
        yield df.where(cond)


_VW = "(PARTITION BY coalesce(nameDest, 'UNKNOWN_DEST') ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("stream_velocity", txn_sql(f"""
SELECT txn_id, coalesce(nameDest, 'UNKNOWN_DEST') AS nameDest, step,
       CAST(count(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN 1 END) OVER {_VW} AS BIGINT) AS dest_prior_count,
       coalesce(CAST(step - max(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN step END) OVER {_VW} AS DOUBLE), -1.0) AS dest_steps_since_last,
       CAST(max(CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN step END) OVER {_VW} IS NULL AS INTEGER) AS dest_first_seen
FROM transactions"""))
def stream_velocity(spark, sf):
    """Stateful destination velocity over a request stream arriving in step order."""
    t = transactions(spark, sf)
    req = t.select("txn_id", "type", "step", "nameDest")
    src, out, state, ckpt = (J.scratch(spark, f"vel-{x}") for x in ("src", "out", "state", "ckpt"))
    for part in _arrivals(req):
        # what has arrived is one micro-batch, in as many files as Spark writes
        part.write.mode("append").parquet(src)
        velocity_stream(spark.readStream.schema(req.schema).parquet(src), out, state, ckpt)
    return spark.read.parquet(out).drop("epoch")


def _log_slices(spark, sf):
    """Stand-in log text of scored events, in arrival slices."""
    s, _ = scored(spark, sf)
    return [EV.stand_in_lines(part) for part in _arrivals(EV.event_records(s))]


_EVENTS_SQL = txn_sql(f"""
SELECT 'txn_' || CAST(txn_id AS VARCHAR) AS transaction_id, type, decision,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(step - 1), '%Y-%m-%dT%H:%M:%SZ') AS event_time_utc
FROM sc WHERE NOT ({_R['blank']}) AND NOT ({_R['junk']})""", ctes=SCORED_CTE)
EVENT_KEYS = ["transaction_id", "type", "decision", "event_time_utc"]


@query("stream_dedup", _EVENTS_SQL)
def stream_dedup(spark, sf):
    """Q5 on a stream: re-delivered scored events dropped by transaction_id within the watermark."""
    src, out, ckpt = J.scratch(spark, "events-src"), J.scratch(spark, "dedup-out"), J.scratch(spark, "dedup-ckpt")
    slices = _log_slices(spark, sf)
    # at-least-once delivery: the first slice arrives twice
    for part in [slices[0], *slices]:
        part.write.mode("append").text(src)
    s = J.read_event_stream(spark, src).where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    J.run_available_now(J.dedup_events(s, watermark=f"{S.DEFAULT_STEP} hours"), out, ckpt)
    return spark.read.parquet(out).select(*EVENT_KEYS)


@query("stream_ingest", _EVENTS_SQL)
def stream_ingest(spark, sf):
    """Two availableNow runs over a growing log; the second appends only the new files."""
    src, table, ckpt = J.scratch(spark, "ingest-src"), J.scratch(spark, "ingest-table"), J.scratch(spark, "ingest-ckpt")
    slices = _log_slices(spark, sf)
    for run in (slices[:2], slices[2:]):
        for part in run:
            part.write.mode("append").text(src)
        J.ingest_events(spark, src, table, ckpt)
    return spark.read.parquet(table).select(*EVENT_KEYS)


@query("stream_rolling", txn_sql(f"""
SELECT step + k AS window_end_step, count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud,
       CAST(sum(CASE WHEN decision IN ('REVIEW','BLOCK') THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
       CAST(sum(CASE WHEN isFraud = 1 AND decision IN ('REVIEW','BLOCK') THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM sc, range(0, 168) r(k)
WHERE type IN ('TRANSFER','CASH_OUT') AND NOT ({_R['blank']}) AND NOT ({_R['junk']}) AND {_R['no_label']}
GROUP BY 1""", ctes=SCORED_CTE))
def stream_rolling(spark, sf):
    """MN5 on a stream: 168-hour sliding windows (1-hour slide) of labelled scored events."""
    src, out, ckpt = J.scratch(spark, "events-src"), J.scratch(spark, "roll-out"), J.scratch(spark, "roll-ckpt")
    for part in _log_slices(spark, sf):
        part.write.mode("append").text(src)
        s = J.read_event_stream(spark, src).where(F.col("_corrupt_record").isNull())
        J.write_updates(J.hourly_counts(s.where(F.col("type").isin(S.FRAUD_TYPES))), out, ckpt)
    return J.rolling_from_hours(J.latest_hours(spark, out))


@query("stream_scoring", txn_sql("""
SELECT txn_id, decision, fraud_probability, risk_signals, reason, dest_prior_count, dest_steps_since_last, dest_first_seen FROM sc""",
                                 ctes=SCORED_CTE))
def stream_scoring(spark, sf):
    """P1-P10 on a stream: requests in step order -> velocity state -> features -> decisions (file sink)."""
    _, t = test_threshold(spark, sf)
    req = transactions(spark, sf)
    src, out, state, ckpt = (J.scratch(spark, f"score-{x}") for x in ("src", "out", "state", "ckpt"))
    for part in _arrivals(req):
        part.write.mode("append").parquet(src)
        score_stream(spark.readStream.schema(req.schema).parquet(src), "score", t, out, state, ckpt)
    return spark.read.parquet(out).select("txn_id", "decision", "fraud_probability", "risk_signals", "reason",
                                          "dest_prior_count", "dest_steps_since_last", "dest_first_seen")
