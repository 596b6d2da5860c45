"""Local stand-in for the driver's correctness gate: Spark result vs DuckDB SQL."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from ledgerlens.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        # pandas turns an int column with NULLs into float; compare by value
        return int(v) if v.is_integer() else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(repr(_norm(x)) for x in rec))
    return sorted(out)


def _spark_type(dt) -> str:
    from pyspark.sql import types as T

    names = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
             T.BooleanType: "BOOLEAN", T.TimestampNTZType: "TIMESTAMP", T.FloatType: "FLOAT"}
    for k, v in names.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, T.ArrayType):
        return _spark_type(dt.elementType) + "[]"
    return str(dt)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    rel = con.sql(sql)
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    spark_types = {f.name: _spark_type(f.dataType) for f in spark_df.schema.fields}
    if spark_types.keys() == oracle_types.keys() and spark_types != oracle_types:
        diff = {k: (spark_types[k], oracle_types[k]) for k in spark_types if spark_types[k] != oracle_types[k]}
        return False, f"column types differ (spark, oracle): {diff}"
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count spark={len(s)} oracle={len(o)}"
    rs, ro = _rows(s), _rows(o)
    if rs != ro:
        bad = [(a, b) for a, b in zip(rs, ro) if a != b][:3]
        return False, f"values differ, e.g. {bad}"
    return True, f"{len(s)} rows ok"
