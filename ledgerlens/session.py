"""Spark session helpers.

The library never owns cluster settings: on a cluster the session comes from
the launcher and every knob below is only a default for local runs and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for local runs. On a cluster the launcher's values win because
# `getOrCreate` returns the existing session untouched.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # local mode: the driver JVM is the executor
    "spark.driver.memory": "16g",
    # 64 MB input splits bound per-task memory at scale
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}


def get_spark(app: str = "ledgerlens", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we only set our
    own (a fresh scratch folder) when it is unset, as in local tests.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("LEDGERLENS_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    """Integer setting from the session conf (e.g. `spark.ledgerlens.velocity.hotKeyRows`), else the default."""
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else int(default)
