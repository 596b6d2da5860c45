"""Operator 6: URL filter by rules and by a character language-model ratio.

Rules (host suffix and path prefix, the longest fits) judge a URL first; the
URLs they judge are the accepted and rejected training sets. For the others two
variable-order Markov models over characters compare their log-likelihoods: a
character is predicted from up to ORDER characters before it, and every order
is interpolated with the next shorter one (Witten-Bell: the weight of a context
follows from how often and how variously it was seen). The difference of
log-likelihoods per character is held against a threshold that is calibrated on
URLs left out of the training (two folds, each scored by the other's model).

Every URL of the table adds its counts, in an aggregation that Spark shuffles
by n-gram. What reaches the driver and the tasks is bounded by the alphabet, not by the data:
SYMBOLS ** (ORDER + 1) counts for each class and fold (under 3 million), held
as dense arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed values of the contract: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 3
# a-z, digits as one, ten marks of URLs, any other ASCII, bytes beyond ASCII, and start of text
MARKS = "/.-_?=&#%:"
SYMBOLS = 26 + 1 + len(MARKS) + 2 + 1
START = SYMBOLS - 1
FOLDS = 2
BINS = 400
RANGE = 4.0

_CODE = np.full(256, 26 + 1 + len(MARKS), dtype=np.int64)
_CODE[128:] += 1
for _i in range(26):
    _CODE[ord("a") + _i] = _CODE[ord("A") + _i] = _i
for _c in "0123456789":
    _CODE[ord(_c)] = 26
for _i, _c in enumerate(MARKS):
    _CODE[ord(_c)] = 27 + _i


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for a null or a URL without `://`."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits a host or its subdomains and a path prefix; null if none fits."""
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def _grams(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the last ORDER + 1 symbols at every byte of every URL, and the URL's number at each."""
    raw = pc.fill_null(urls.cast(pa.large_binary()), b"")
    off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    n = off[1:] - off[:-1]
    buf = raw.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    which = np.repeat(np.arange(len(raw)), n)
    sym = _CODE[data]
    place = np.arange(len(data)) - np.repeat(off[:-1] - off[0], n)
    code = sym.copy()
    for k in range(1, ORDER + 1):
        before = np.where(place >= k, np.concatenate([np.zeros(k, np.int64), sym])[: len(sym)], START)
        code += before * SYMBOLS**k
    return code, which


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each n-gram code by (class, fold) within a batch."""
    for b in batches:
        code, which = _grams(b.column(2))
        key = (b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) * FOLDS + b.column(1).to_numpy(zero_copy_only=False))[which]
        u, n = np.unique(key * SYMBOLS ** (ORDER + 1) + code, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], names=["gram", "n"])


def log_model(counts: np.ndarray) -> np.ndarray:
    """Dense log P(symbol | last ORDER symbols) from dense counts, Witten-Bell from order 0 (uniform below) upwards."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for k in range(ORDER + 1):
        c = counts.reshape(-1, SYMBOLS ** (k + 1)).sum(axis=0).reshape(-1, SYMBOLS)
        n, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p.reshape(-1, SYMBOLS), (len(c) // len(p.reshape(-1, SYMBOLS)), 1))
        p = np.where(n > 0, (c + kinds * lower) / np.maximum(n + kinds, 1), lower)
    return np.log(p).astype(np.float32).reshape(-1)


def _scorer(ratios: list[np.ndarray], by_fold: bool):
    """mapInArrow function: (key, fold, url) -> (key, score); fold f is scored by ratios[f]."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, which = _grams(b.column(2))
            n = np.bincount(which, minlength=b.num_rows)
            out = np.zeros(b.num_rows)
            fold = b.column(1).to_numpy(zero_copy_only=False) if by_fold else np.zeros(b.num_rows, np.int64)
            for f, ratio in enumerate(ratios):
                s = np.bincount(which, weights=ratio[code], minlength=b.num_rows) / np.maximum(n, 1)
                out = np.where(fold == f, s, out)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["key", "score"])

    return score


def best_threshold(hist: dict[tuple[str, int], int]) -> float:
    """Cut of the score histogram with the least sum of both classes' error rates; 0 if a class has no URL."""
    allow, block = (np.array([hist.get((c, i), 0) for i in range(BINS)], dtype=float) for c in ("allow", "block"))
    if not allow.sum() or not block.sum():
        return 0.0
    missed = np.concatenate([[0], np.cumsum(allow)]) / allow.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(block)]) / block.sum()
    total = missed + passed
    best = np.flatnonzero(total <= total.min() + 1e-12)
    # the middle of all equally good cuts
    return float((best[0] + best[-1]) / 2 * (2 * RANGE / BINS) - RANGE)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row.

    `score` is the length-normalised log-likelihood difference (accepted minus
    rejected); the verdict is the rule's, else allow where score >= the
    calibrated threshold. A null or empty URL scores 0; without URLs of a class
    all scores and the threshold are 0 (allow). Repeated rows are judged each;
    an empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rows = rows.withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
    fold = F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(FOLDS)).cast("long")
    known = rows.where("judged is not null").select((F.col("judged.verdict") == "allow").cast("long").alias("class"), fold.alias("fold"), "url")
    grams = known.mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    size = SYMBOLS ** (ORDER + 1)
    counts = np.zeros(2 * FOLDS * size)
    got = grams.toArrow()  # at most 4 * SYMBOLS ** (ORDER + 1) rows
    counts[got.column("gram").to_numpy()] = got.column("n").to_numpy()
    counts = counts.reshape(2, FOLDS, size)
    seen = counts.sum(axis=(1, 2)) > 0
    zero = np.zeros(size, np.float32)
    ratio = lambda c: log_model(c[1]) - log_model(c[0]) if seen.all() else zero

    held_out = [ratio(counts.sum(axis=1) - counts[:, f]) for f in range(FOLDS)]
    labelled = rows.where("judged is not null").select(F.col("judged.verdict").alias("key"), fold.alias("fold"), "url")
    scores = labelled.mapInArrow(_scorer(held_out, True), "key string, score double")
    place = F.least(F.greatest(F.floor((F.col("score") + RANGE) / (2 * RANGE / BINS)), F.lit(0)), F.lit(BINS - 1))
    hist = {(r["key"], int(r["bin"])): int(r["n"]) for r in scores.groupBy("key", place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
    threshold = best_threshold(hist)

    key = F.struct("page_id", "host", "path", "judged")
    full = rows.select(key.alias("key"), F.lit(0).cast("long").alias("fold"), "url")
    kind = full.schema["key"].dataType.simpleString()
    out = full.mapInArrow(_scorer([ratio(counts.sum(axis=1))], False), f"key {kind}, score double")
    by_model = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return out.select(
        "key.page_id", "key.host", "key.path", F.col("key.judged.rule").alias("rule"),
        F.coalesce(F.col("key.judged.verdict"), by_model).alias("verdict"), "score",
    )
