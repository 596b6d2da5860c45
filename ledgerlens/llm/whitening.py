"""Operator 13: whitening of embeddings by the covariance of their distinct quantised vectors.

1. Rows with a usable vector get x = floor(256 * entry) and the SHA-256 of x.
2. Identical x vectors are grouped by that digest (map-side partials, so a
   vector that fills a third of all rows is no hot group). The fit list is each
   distinct vector, weighted by one or by its number of rows.
3. Sums, then the weighted centred GEMM: one matrix a task, of centred vectors, added
   up by entry. Only figures of the dimension's size (sums, covariance) reach the driver,
   which takes the eigenvectors.
4. Each distinct vector is whitened once, and the results are joined back to
   the rows by digest. Vectors of many rows (above HOT_SHARE of all, so at most 1 / HOT_SHARE
   of them) are spread over salts.

Edge cases: a null vector, or one with a null, NaN or infinite entry, has no
result; nor has an empty one, or one whose length is not the table's most
frequent (the longer among equals). Repeated rows and null ids are rows each. A component
without variance (one distinct vector, constant or dependent dimensions) has
null `whitened`, and null `explained` where the whole variance is 0;
`identity_error` covers the components that have variance (null: none). `deviation` is null
where it exceeds a long. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE = 256.0
COMPONENTS = 4
HOT_SHARE = 0.001
SALTS = 64
# Eigenvalues below this share of the largest count as no variance.
RANK_TOLERANCE = 1e-12

OUT_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector has entries, all of them finite."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)


def _matrix(column: pa.Array, dim: int, dtype) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, dim)


def quantised(rows: DataFrame, dim: int) -> DataFrame:
    """(vec_id, key, x) of rows (vec_id, v) of length `dim`: key is the digest of x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = (np.floor(SCALE * _matrix(b.column(1), dim, np.float64)) + 0.0).astype("<i8")
            keys = [hashlib.sha256(r).digest() for r in x]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dim, pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), lists], names=["vec_id", "key", "x"])

    return rows.where(F.size("v") == dim).mapInArrow(run, "vec_id long, key binary, x array<long>")


def distinct_vectors(rows: DataFrame, weights: str = "one") -> DataFrame:
    """(key, x, n_rows, weight) of each distinct x, written to the shared folder."""
    if weights not in ("one", "count"):
        raise ValueError(f"weights are 'one' or 'count', not {weights!r}")
    d = rows.groupBy("key").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n_rows"))
    return stored(d.withColumn("weight", F.col("n_rows") if weights == "count" else F.lit(1).cast("long")), "whiten-distinct")


def sums(distinct: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """(n, S): weight of the fit list and its per-dimension sums, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim, np.int64), 0
        for b in batches:
            w = b.column(1).to_numpy()
            total += w @ _matrix(b.column(0), dim, np.int64)
            n += int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(total), pa.array(np.full(dim, n))], names=["i", "s", "n"])

    parts = distinct.select("x", "weight").mapInArrow(run, "i long, s long, n long")
    got = {r["i"]: (r["s"], r["n"]) for r in parts.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    return got[0][1], np.array([got[i][0] for i in range(dim)], dtype=np.int64)


def covariance(distinct: DataFrame, dim: int, n: int, total: np.ndarray) -> np.ndarray:
    """Weighted covariance of the fit list (divisor n), from vectors centred before they are multiplied."""
    mean = total / n
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((dim, dim))
        for b in batches:
            c = _matrix(b.column(0), dim, np.float64) - mean
            m += (c * b.column(1).to_numpy().astype(np.float64)[:, None]).T @ c
        yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), pa.array(m[upper])], names=["i", "j", "v"])

    parts = distinct.select("x", "weight").mapInArrow(run, "i long, j long, v double")
    v = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    return v


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors in columns (largest entry positive)."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    top = np.abs(u).argmax(axis=0)
    return e, u * np.where(u[top, np.arange(u.shape[1])] < 0, -1.0, 1.0)


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 of each row, exact; None beyond a long."""
    most = int(np.abs(x).max(initial=0)) * n + int(np.abs(total).max(initial=0))
    if most * most * x.shape[1] < 2**63:
        d = x * n - total
        return (d * d).sum(axis=1).tolist()
    s = total.tolist()
    exact = (sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x.tolist())
    return [d if d < 2**63 else None for d in exact]


def project(distinct: DataFrame, dim: int, n: int, total: np.ndarray, e: np.ndarray, u: np.ndarray) -> DataFrame:
    """(key, n_rows, weight, deviation, w) of each distinct vector: w holds its whitened components (null: no variance)."""
    varied = e > RANK_TOLERANCE * max(float(e[0]), 0.0)
    map_to = u / np.sqrt(np.where(varied, e, 1.0))
    mean = total / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim, np.int64)
            w = (x.astype(np.float64) - mean) @ map_to
            flat = pa.array(w.reshape(-1), mask=np.tile(~varied, len(x)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(e), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(_deviations(x, n, total), pa.int64()), lists],
                names=["key", "n_rows", "weight", "deviation", "w"])

    out = distinct.select("key", "x", "n_rows", "weight").mapInArrow(run, "key binary, n_rows long, weight long, deviation long, w array<double>")
    return stored(out, "whiten-distinct-out")


def identity_error(projected: DataFrame, varied: list[int]) -> float | None:
    """Largest entry of |covariance of the whitened fit list - identity| over the components with variance."""
    if not varied:
        return None
    at = {i: F.get("w", F.lit(i)) for i in varied}
    weight = F.col("weight").cast("double")
    means = projected.agg(*[(F.sum(weight * c) / F.sum(weight)).alias(f"m{i}") for i, c in at.items()]).first()
    pairs = [(i, j) for i in varied for j in varied if i <= j]
    moment = lambda i, j: F.sum(weight * (at[i] - F.lit(means[f"m{i}"])) * (at[j] - F.lit(means[f"m{j}"]))) / F.sum(weight)
    row = projected.agg(*[moment(i, j).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, weights: str = "one",
) -> DataFrame:
    """OUT_SCHEMA rows: each usable row's whitened components, with n, deviation, explained share and identity error."""
    spark = vectors.sparkSession
    src = usable(vectors, id_col, vec_col)
    lengths = src.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n_rows"))
    common = lengths.agg(F.max(F.struct("n_rows", "d")).alias("best")).first()["best"]
    if common is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    n_all, dim = common
    rows = quantised(src, dim)
    distinct = distinct_vectors(rows, weights)
    n, total = sums(distinct, dim)
    v = covariance(distinct, dim, n, total)
    e, u = principal(v, min(components, dim))
    trace = float(np.trace(v))
    projected = project(distinct, dim, n, total, e, u)
    error = identity_error(projected, [i for i in range(len(e)) if e[i] > RANK_TOLERANCE * max(float(e[0]), 0.0)])
    joined = _joined(rows.select("vec_id", "key"), projected, n_all)
    share = F.array(*[F.lit(float(x) / trace if trace > 0 else None).cast("double") for x in e])
    out = joined.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return out.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("i")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def _joined(rows: DataFrame, projected: DataFrame, n_all: int) -> DataFrame:
    """rows (vec_id, key) with their vector's results; vectors of many rows are joined by salted keys."""
    hot = F.col("n_rows") > max(HOT_SHARE * n_all, 1000)
    # at most 1 / HOT_SHARE vectors
    salted = F.broadcast(projected.where(hot).select("key", F.lit(SALTS).alias("salts")))
    left = rows.withColumn("row", F.monotonically_increasing_id()).join(salted, "key", "left")
    left = left.select("vec_id", "key", F.coalesce(F.pmod(F.col("row"), F.col("salts")), F.lit(0)).cast("int").alias("salt"))
    spread = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    right = projected.select("key", "deviation", "w", spread.alias("salt"))
    return left.join(right, ["key", "salt"])
