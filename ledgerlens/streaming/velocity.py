"""Stateful destination velocity on a stream (P7), one micro-batch at a time.

The state of a destination is (count, last step) of its state-updating requests so far. A
micro-batch is ordered by (step, txn_id) inside each destination; a row reads
the state before it, and only rows of the fraud universe without caller-supplied velocity
update it, so features stay causal. When events arrive in (step, id) order
the output equals one batch over all of them.

The state is a table of increments: every micro-batch adds one pre-aggregated
row per destination it updated, under its epoch. Counts add up and steps take their
maximum, so a destination with a third of all rows costs one row an epoch, and
reading joins only the destinations of the batch. Every COMPACT_EPOCHS the
increments are merged into a base. A replayed epoch reads the epochs
before it and overwrites its own output and increment, so it adds nothing.

Inside a micro-batch a destination with many rows is split by (step, id)
ranges (`ranks.row_positions`): no task holds all rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import ranks
from ..operators.features import HOT_KEY_ROWS
from ..session import conf_int

VELOCITY_COLUMNS = ("dest_prior_count", "dest_steps_since_last", "dest_first_seen")
STATE_SCHEMA = "nameDest string, state_count long, state_step long, epoch int"
COMPACT_EPOCHS = 50


def updating(requests: DataFrame):
    """Rows that advance the state: in the fraud universe, without velocity of their own."""
    own = F.col("dest_prior_count").isNotNull() if "dest_prior_count" in requests.columns else F.lit(False)
    return F.coalesce(F.col("type").isin(S.FRAUD_TYPES), F.lit(False)) & ~own


def batch_velocity(requests: DataFrame, history: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """(txn_id, nameDest, step, VELOCITY_COLUMNS): what each request of a batch reads, given the state `history` before it.

    `history` is (nameDest, state_count, state_step). Null destinations are UNKNOWN_DEST, null steps the default step.
    """
    x = requests.select(
        F.col("txn_id").cast("long").alias("txn_id"), F.coalesce("nameDest", F.lit(S.UNKNOWN_DEST)).alias("nameDest"),
        F.coalesce(F.col("step").cast("long"), F.lit(S.DEFAULT_STEP).cast("long")).alias("step"), updating(requests).cast("long").alias("__u"))
    limit = hot_rows or conf_int(requests.sparkSession, "spark.ledgerlens.velocity.hotKeyRows", HOT_KEY_ROWS)
    most = x.groupBy("nameDest").count().agg(F.max("count")).first()[0] or 0
    if most <= limit:
        earlier = Window.partitionBy("nameDest").orderBy("step", "txn_id").rowsBetween(Window.unboundedPreceding, -1)
        x = x.withColumns({
            "__n": F.coalesce(F.sum("__u").over(earlier), F.lit(0)),
            "__last": F.max(F.when(F.col("__u") == 1, F.col("step"))).over(earlier)})
    else:
        # rows before by split positions; the step of the last updating row by (destination, step) cells
        cells = x.groupBy("nameDest", "step").agg(F.sum("__u").alias("__c"))
        cells = ranks.cumulative(cells, ["nameDest"], ["step"], ["__c"], prefix="__before")
        before = Window.partitionBy("nameDest").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("__prev", F.max(F.when(F.col("__c") > 0, F.col("step"))).over(before)).drop("__c")
        x = ranks.row_positions(x, ["nameDest"], "step", "txn_id", out="__pos", sums={"__u": "__n"})
        x = x.join(cells, ["nameDest", "step"])
        x = x.withColumn("__last", F.when(F.col("__n") > F.col("__before__c"), F.col("step")).otherwise(F.col("__prev")))
    if history is not None:
        # one row per destination: joins by Spark's choice
        x = x.join(history.select("nameDest", "state_count", "state_step"), "nameDest", "left")
        x = x.withColumns({"__n": F.col("__n") + F.coalesce("state_count", F.lit(0)), "__last": F.coalesce("__last", "state_step")})
    since = F.coalesce((F.col("step") - F.col("__last")).cast("double"), F.lit(-1.0))
    return x.select("txn_id", "nameDest", "step", F.col("__n").cast("long").alias("dest_prior_count"), since.alias("dest_steps_since_last"),
                    F.col("__last").isNull().cast("int").alias("dest_first_seen"))


class VelocityState:
    """The increments of a stream under a folder: epoch=<n> and, merged up to an epoch, base=<n>."""

    def __init__(self, spark: SparkSession, folder: str, compact_epochs: int = COMPACT_EPOCHS):
        self.spark, self.folder, self.compact_epochs = spark, folder.rstrip("/"), compact_epochs

    def _numbers(self, kind: str) -> list[int]:
        """Committed folders <kind>=<n>."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}=*/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)

    def before(self, epoch: int) -> DataFrame | None:
        """(nameDest, state_count, state_step) after all epochs before `epoch`; None if there are none."""
        base = max((n for n in self._numbers("base") if n < epoch), default=-1)
        parts = ([f"{self.folder}/base={base}"] if base >= 0 else []) + [f"{self.folder}/epoch={n}" for n in self._numbers("epoch") if base < n < epoch]
        if not parts:
            return None
        rows = self.spark.read.schema("nameDest string, state_count long, state_step long").parquet(*parts)
        return rows.groupBy("nameDest").agg(F.sum("state_count").alias("state_count"), F.max("state_step").alias("state_step"))

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Write the increment of an epoch, and now and then a base."""
        rows = batch.where(updating(batch)).select(
            F.coalesce("nameDest", F.lit(S.UNKNOWN_DEST)).alias("nameDest"), F.coalesce(F.col("step").cast("long"), F.lit(S.DEFAULT_STEP).cast("long")).alias("step"))
        new = rows.groupBy("nameDest").agg(F.count(F.lit(1)).alias("state_count"), F.max("step").alias("state_step"))
        new.write.mode("overwrite").parquet(f"{self.folder}/epoch={epoch}")
        if (epoch + 1) % self.compact_epochs == 0:
            self.before(epoch + 1).write.mode("overwrite").parquet(f"{self.folder}/base={epoch}")


def run_stateful(
    requests: DataFrame, make: Callable[[DataFrame, DataFrame | None], DataFrame], out: str, state: VelocityState, ckpt: str, trigger: dict | None = None,
) -> None:
    """Run a stream of requests until nothing is new: each micro-batch writes make(batch, state before it) under its epoch, then its increment."""
    def sink(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        history = state.before(epoch)
        if history is not None:
            # only the batch's destinations are merged
            keys = batch.select(F.coalesce("nameDest", F.lit(S.UNKNOWN_DEST)).alias("nameDest")).distinct()
            history = history.join(keys, "nameDest", "left_semi")
        make(batch, history).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        state.add(batch, epoch)

    q = requests.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()


def stream_velocity(requests: DataFrame, out: str, state: str, ckpt: str, hot_rows: int | None = None) -> None:
    """Velocity of every request of a stream, as `batch_velocity` rows under `out`."""
    run_stateful(requests, lambda b, h: batch_velocity(b, h, hot_rows), out, VelocityState(requests.sparkSession, state), ckpt)
