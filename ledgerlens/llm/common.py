"""Shared helpers: scratch tables, table reading, word expressions and vectorised word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# The white space of the word rule `[^\x20\x09-\x0D]+`.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared folder (`spark.checkpoint.dir`)."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors.

    Used instead of checkpoint(), which runs its input twice (once for the
    action, once for the files).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text column (null: no words), JVM side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


# ---------------------------------------------------------------- key filters

# One row of a key filter holds so many bits (the size of Spark's bitmap aggregate).
_ROW_BITS = 32768


def key_filter(keys: DataFrame, key: str, n: int, most_bits: int = 1 << 27) -> DataFrame:
    """(bucket, bitmap): a bit table over the 64-bit hashes in `key`, for `maybe_in`.

    About 16 bits a key for `n` keys, and never more than `most_bits` (16 MB),
    so it may be broadcast whatever the table's size.
    """
    bits = _ROW_BITS
    while bits < min(16 * n, most_bits):
        bits *= 2
    at = F.pmod(F.col(key), F.lit(bits))
    rows = keys.select((at / _ROW_BITS).cast("long").alias("bucket"), F.pmod(at, F.lit(_ROW_BITS)).alias("bit"))
    out = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return out.select(F.lit(bits).cast("long").alias("bits"), "bucket", "bitmap")


def maybe_in(df: DataFrame, key: Column, stored_filter: DataFrame, bits: int, out: str) -> DataFrame:
    """`df` with boolean `out`: false only where no key of the filter equals `key`."""
    at = F.pmod(key, F.lit(bits))
    table = F.broadcast(stored_filter.select(F.col("bucket").alias("__bucket"), F.col("bitmap").alias("__bitmap")))
    d = df.withColumn("__at", at).join(table, (F.col("__at") / _ROW_BITS).cast("long") == F.col("__bucket"), "left")
    byte = F.expr(f"conv(hex(substring(__bitmap, cast((__at % {_ROW_BITS}) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.expr("cast(__at % 8 as int)")
    hit = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), bit)), F.lit(2)) == 1, F.lit(False))
    return d.withColumn(out, hit).drop("__at", "__bucket", "__bitmap")


def split_by_keys(df: DataFrame, key: Column, keys: DataFrame, key_name: str) -> tuple[DataFrame, DataFrame]:
    """(rows of `df` that may have a key of `keys`, the other rows): only the first need to be shuffled to a join with `keys`."""
    found = stored(key_filter(keys, key_name, keys.count()), "key-filter")
    head = found.first()
    if head is None:
        return df.where(F.lit(False)), df
    marked = maybe_in(df, key, found, head["bits"], "__maybe")
    return marked.where("__maybe").drop("__maybe"), marked.where("not __maybe").drop("__maybe")


# ---------------------------------------------------------------- word hashes

_RNG = np.random.RandomState(20240229)
#: 64-bit weight of each byte value, from a fixed seed (equal on every worker).
_BYTE = (_RNG.randint(1, 2**32, 256).astype(np.uint64) << np.uint64(32)) | _RNG.randint(1, 2**32, 256).astype(np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_GRAM_INV = np.uint64(pow(int(_GRAM), -1, 2**64))
_CHUNK = 1 << 18
#: Rows of a batch that are worked on at once.
SLICE_ROWS = 512
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche step (public-domain 64-bit finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2^64; up to two runs' worth is kept for the next call."""
    if n <= 2 * _CHUNK:
        if int(base) not in _KEPT:
            _KEPT[int(base)] = _power_run(base, 2 * _CHUNK)
        return _KEPT[int(base)][:n]
    return _power_run(base, n)


def _power_run(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split an Arrow string array into runs of documents of about 256 KB.

    Yields (first document, last + 1, bytes, document offsets into the bytes);
    nulls count as empty. Bounds the copies and numpy temporaries of a batch to SLICE_ROWS
    documents; a longer single text forms its own run.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for base in range(0, len(texts), SLICE_ROWS):
        part = pc.fill_null(texts.slice(base, SLICE_ROWS).cast(pa.large_string()), "")
        off = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        raw = part.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        i, n = 0, len(part)
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + _CHUNK, side="right")) - 1)
            j = min(j, n)
            yield base + i, base + j, data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of SLICE_ROWS rows: what a task makes of its rows at once stays small."""
    for b in batches:
        for lo in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(lo, SLICE_ROWS)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word of a run of documents.

    Returns (hashes, first word of each document [n + 1], word starts, word
    ends in bytes). Words never cross documents; A-Z are lower-cased when
    `lower`. The hash is a polynomial over byte weights modulo 2^64, followed by
    an avalanche step: two different words share one with probability of about
    2^-64.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), z, z
    word = _IS_WORD[data]
    # a document's first byte always starts a new word
    inner = offsets[(offsets > 0) & (offsets < n)]
    change = np.empty(n + 1, dtype=np.int8)
    change[0] = word[0]
    change[1:n] = word[1:].astype(np.int8) - word[:-1].astype(np.int8)
    change[n] = -np.int8(word[-1])
    starts = change[:n] == 1
    ends = change == -1
    joined = inner[word[inner] & word[inner - 1]]
    starts[joined] = True
    ends[joined] = True
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        w = _BYTE[_LOWER[data]] if lower else _BYTE[data]
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(w * _powers(_BASE, n), out=total[1:], dtype=np.uint64)
        h = (total[e] - total[s]) * _powers(_BASE_INV, n)[s]
    first = np.searchsorted(s, offsets, side="left").astype(np.int64)
    return mix64(h), first, s, e


def run_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One order-aware hash for each run [first, last) of word hashes."""
    n = len(hashes)
    total = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n:
            np.cumsum(hashes * _powers(_GRAM, n), out=total[1:], dtype=np.uint64)
        return mix64((total[last] - total[first]) * _powers(_GRAM_INV, n + 1)[first] + (last - first).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` consecutive words (empty if there are fewer)."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        g = np.zeros(m, dtype=np.uint64)
        for i in range(k):
            g = g * _GRAM + words[i : i + m]
    return mix64(g)
