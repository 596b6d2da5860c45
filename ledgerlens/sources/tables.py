"""Readers for the driver's parquet tables and the transaction base files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S3: parquet scan. Column pruning and filter pushdown come from Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_base_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV scan of the 11-column base table with an explicit schema.

    Never infers types (a full extra pass at scale and unstable results);
    `columns` projects like `usecols`, and Catalyst prunes the CSV parse.
    """
    df = spark.read.schema(S.BASE_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.select(*columns) if columns else df


def read_enriched(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of the enriched table, optionally with named columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink (overwrite). Partition big outputs by a low-cardinality key."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    """CSV sink for small result tables (one file; only for bounded results)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
