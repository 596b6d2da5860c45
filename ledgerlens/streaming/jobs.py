"""Structured Streaming jobs: event ingest, de-duplication, rolling windows (S8, S12, Q5, MN5).

Every job reads a file source with an explicit schema, runs with
`trigger(availableNow=True)` (process what is new, then stop: the replacement
of the size/mtime polling scheduler) and commits progress to a checkpoint
folder only when a micro-batch succeeds, so a failed run never skips events
and a lost executor just replays the uncommitted batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import flag
from ..session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory named by the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Tolerant JSON-lines stream of scored events (malformed lines kept aside in _corrupt_record)."""
    r = spark.readStream.schema(S.EVENT_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def event_time(df: DataFrame) -> DataFrame:
    """Parse the ISO-8601 UTC stamp as an instant (the trailing Z is read as the UTC offset).

    An unreadable stamp gives NULL: one bad record never ends a stream.
    """
    return df.withColumn("event_time", F.try_to_timestamp("event_time_utc", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


# Origin of the step clock (step 1 = the hour starting here), as epoch seconds (UTC).
STEP_ORIGIN_EPOCH = 1704067200


def window_end_step(window_end: str = "window.end"):
    """Step number of the last hour inside a window with exclusive end `window_end`."""
    return ((F.unix_seconds(F.col(window_end)) - F.lit(STEP_ORIGIN_EPOCH)) / 3600).cast("long")


def run_available_now(stream: DataFrame, sink_path: str, ckpt: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Process everything new once, commit, stop (S8 file sink / S12 change detection)."""
    q = (stream.writeStream.format(fmt).outputMode(mode).option("path", sink_path)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_events(spark: SparkSession, source: str, table: str, ckpt: str) -> None:
    """S12 + S8: append only the new, well-formed events of the log folder to the event table."""
    s = read_event_stream(spark, source)
    good = s.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    run_available_now(good, table, ckpt)


def dedup_events(stream: DataFrame, watermark: str = "24 hours") -> DataFrame:
    """Q5 on a stream: drop re-delivered events (same transaction_id) within the watermark."""
    return event_time(stream).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["transaction_id"])


def hourly_counts(stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """MN5 on a stream, first half: n, fraud, flagged and true positives of labelled events per hour.

    One row per hour and key of state; the 168-hour windows follow from the
    hourly table (`rolling_from_hours`), so no event is multiplied by its windows.
    """
    e = event_time(stream).where(F.col("actual_label").isNotNull() & F.col("event_time").isNotNull())
    label = F.col("actual_label").try_cast("int")
    flagged = flag(F.col("decision").isin("REVIEW", "BLOCK"))
    return (e.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 hour"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("fraud"), F.sum(flagged).alias("flagged"),
                 F.sum(flag((label == 1) & (flagged == 1))).alias("tp"))
            .select(window_end_step().alias("step"), "n", "fraud", "flagged", "tp"))


def write_updates(stream: DataFrame, out: str, ckpt: str) -> None:
    """Write the rows that each micro-batch changed under its own epoch folder (a replayed batch overwrites its own)."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def latest_hours(spark: SparkSession, out: str) -> DataFrame:
    """The hourly table: of each hour the row of its last epoch."""
    rows = spark.read.option("basePath", out).parquet(out)
    last = F.max_by(F.struct("n", "fraud", "flagged", "tp"), "epoch")
    return rows.groupBy("step").agg(last.alias("v")).select("step", "v.*")


def rolling_from_hours(hours: DataFrame, window_hours: int = S.ROLLING_WINDOW_STEPS) -> DataFrame:
    """Sliding windows of `window_hours`, one per hour at its end, from the hourly table (one row per hour)."""
    span = hours.agg(F.min("step").alias("a"), F.max("step").alias("b")).where("a is not null")
    ends = span.select(F.explode(F.sequence(F.col("a"), F.col("b") + (window_hours - 1))).alias("step"))
    w = Window.orderBy("step").rangeBetween(-(window_hours - 1), 0)
    full = ends.join(hours, "step", "left")
    cols = {c: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long") for c in ("n", "fraud", "flagged", "tp")}
    return full.select(F.col("step").alias("window_end_step"), *[v.alias(c) for c, v in cols.items()]).where("n > 0")
