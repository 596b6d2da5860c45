"""Operator 4: quality rules from line frequencies across documents.

Lines are normalised (A-Z lower-cased, runs of white space made one space,
digits made 0) and hashed together with the host. For every (host, line) the
distinct documents are counted; a line found in more than `max_documents` of
them, and in more than the share `max_share` of its host's, is boilerplate of the host and is removed: the
count keeps small hosts out, the share makes verdicts independent of how much of a host the table holds. A document is rejected when too
few of its words are left.

Copies of one document would make all of its own lines look like boilerplate,
so documents are told apart by content: the hash of all their distinct
normalised lines. Copies that differ in nothing else count once; near copies
are documents of their own, as nothing tells them from pages of one template.

Python (Arrow, numpy) does the per-document work only: words, repeated windows
and line hashes. Counting across documents is Spark's: explode, a distinct that
is pre-aggregated before the shuffle, and a join with the frequent lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, mix64, run_hashes, slices, split_by_keys, stored, text_chunks, word_hashes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line in more than so many distinct documents of one host, and in more than this share of them, is removed.
MAX_DOCUMENTS = 20
MAX_SHARE = 0.05
# A document that loses more than this share of its words is rejected.
MAX_LOST_SHARE = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_DIGIT = np.arange(256, dtype=np.uint8)
_DIGIT[ord("0") : ord("9") + 1] = ord("0")

LINE_SCHEMA = (
    "key struct<doc_id: long, th: long>, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<h: long, n: long>>, content long, host long"
)
LINE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "content", "host")


def _repeat_words(words: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    g = gram_hashes(words, 3)
    if len(g) < 2:
        return 0
    _, inverse, counts = np.unique(g, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base metrics and normalised line hashes of every whole text of (key, host_hash, text)."""
    for batch in slices(batches):
        ids, hosts = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        cols: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        line_h, line_n, line_off, content = [], [], [0], []
        for a, b, data, off in text_chunks(batch.column(2)):
            exact, first, s, e = word_hashes(data, off, lower=False)
            loose, _, _, _ = word_hashes(_DIGIT[data], off, lower=True)
            in_word = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80))])
            chars = np.concatenate([[0], np.cumsum(in_word[e] - in_word[s])])
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
            newline = np.flatnonzero(data == 10)
            for d in range(b - a):
                lo, hi, w0, w1 = off[d], off[d + 1], first[d], first[d + 1]
                cols["n_words"].append(w1 - w0)
                cols["word_chars"].append(chars[w1] - chars[w0])
                cols["n_symbols"].append(symbols[hi] - symbols[lo])
                cols["n_repeat_words"].append(_repeat_words(exact[w0:w1]))
                cuts = newline[np.searchsorted(newline, lo) : np.searchsorted(newline, hi)]
                # the words of line i are [edge[i], edge[i + 1])
                edge = np.concatenate([[w0], w0 + np.searchsorted(s[w0:w1], cuts), [w1]])
                full = np.flatnonzero(edge[1:] > edge[:-1])
                starts = np.concatenate([[lo], cuts + 1])
                stops = np.concatenate([cuts, [hi]])
                seen = {bytes(data[starts[i] : stops[i]]) for i in full}
                cols["n_dup_lines"].append(len(full) - len(seen))
                h = run_hashes(loose[w0:w1], edge[full] - w0, edge[full + 1] - w0)
                u, inverse = np.unique(h, return_inverse=True)
                n = np.bincount(inverse, weights=(edge[full + 1] - edge[full]), minlength=len(u)).astype(np.int64)
                content.append(run_hashes(u, np.zeros(1, np.int64), np.array([len(u)]))[:1].view(np.int64))
                u = mix64(u ^ hosts[a + d]).view(np.int64)
                line_h.append(u)
                line_n.append(n)
                line_off.append(line_off[-1] + len(u))
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        lines = pa.StructArray.from_arrays([pa.array(flat(line_h)), pa.array(flat(line_n))], names=["h", "n"])
        yield pa.RecordBatch.from_arrays(
            [ids, *[pa.array(np.array(v, dtype=np.int64)) for v in cols.values()],
             pa.ListArray.from_arrays(pa.array(line_off, pa.int32()), lines), pa.array(flat(content)), batch.column(1)],
            names=["key", *cols, "lines", "content", "host"],
        )


def line_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_documents: int = MAX_DOCUMENTS, max_lost_share: float = MAX_LOST_SHARE, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE,
) -> DataFrame:
    """One row per document:

    doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_words, kept. A document is kept if it
    passes the base rules (at least `min_words` words, at most half of them in
    repeated 3-word windows), loses at most `max_lost_share` of its words with
    the removed lines.

    Edge cases: a null text has no words and fails; a null host is a host of
    its own; rows that share an id are judged each, as rows; repeated rows
    count as copies; an empty table gives empty tables; other columns are not read.
    """
    return _judged(docs, id_col, text_col, host_col, max_documents, max_lost_share, min_words, max_share)[0].drop("row", "th")


def _judged(
    docs: DataFrame, id_col: str, text_col: str, host_col: str,
    max_documents: int = MAX_DOCUMENTS, max_lost_share: float = MAX_LOST_SHARE, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """Verdicts by `row`, with `th` (hash of text and host), and (row, __gone): the removed hashes of rows that have any."""
    host = F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit("\u0000")))
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text, F.col(host_col).cast("string")).alias("th")).alias("key"),
        host.alias("host_hash"), text.alias("text"))
    m = rows.mapInArrow(measure, LINE_SCHEMA).select("key.*", *LINE_COLUMNS).withColumn("row", F.monotonically_increasing_id())
    m = stored(m, "line-rules")
    lines = m.select("row", "content", "host", F.explode("lines").alias("line"))
    lines = lines.select("row", F.col("line.h").alias("h"), F.col("line.n").alias("n"), "content", "host")
    content = lines.select("h", "content", "host").distinct()
    frequent = content.groupBy("h").agg(F.count(F.lit(1)).alias("n_documents"), F.max("host").alias("host")).where(F.col("n_documents") > max_documents)
    hosts = m.where("n_words > 0").select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    frequent = frequent.join(hosts, "host").where(F.col("n_documents") > max_share * F.col("n_host"))
    hits = lines.join(frequent.select("h"), "h")
    lost = stored(hits.groupBy("row").agg(F.sum("n").alias("lost_words"), F.collect_list("h").alias("__gone")), "line-lost")
    v = m.drop("lines", "content", "host").join(lost.drop("__gone"), "row", "left").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)).cast("long"))
    v = v.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    v = v.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= max_lost_share * F.col("n_words")))
    return v, lost.select("row", "__gone")


def clean_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **options
) -> DataFrame:
    """Kept documents of `docs` without the boilerplate lines of their host; columns as they are.

    Only documents that are rejected or lose lines are shuffled, to the verdicts; a
    key filter of bounded size tells the others, which pass as they are. The hash of every line is computed again as in `line_rules`, so only the
    short list of a document's removed hashes travels to its text.

    Edge cases: as in `line_rules`; rows that share an id, a text and a host are one document here: they are kept or
    rejected alike. A text that loses all its lines becomes empty, if its document is kept; an empty table gives no rows.
    """
    verdicts, gone = _judged(docs, id_col, text_col, host_col, **options)
    one = verdicts.groupBy("doc_id", "th").agg(F.first("row").alias("row"), F.first("kept").alias("kept")).join(gone, "row", "left")
    touched = one.where(~F.col("kept") | F.col("__gone").isNotNull()).withColumn("key", F.xxhash64("doc_id", "th"))
    touched = stored(touched.select("key", F.struct("doc_id", "th").alias("__mark"), F.col("kept").alias("__kept"), "__gone"), "line-touched")
    th = F.xxhash64(F.col(text_col).cast("string"), F.col(host_col).cast("string"))
    some, others = split_by_keys(docs, F.xxhash64(F.col(id_col).cast("long"), th), touched, "key")
    mark = F.struct(F.col(id_col).cast("long").alias("doc_id"), th.alias("th"))
    out = some.join(touched.drop("key"), mark.eqNullSafe(F.col("__mark")), "left").where(F.coalesce("__kept", F.lit(True))).drop("__mark", "__kept")
    columns = docs.columns
    at, kind = columns.index(text_col), docs.schema
    host = F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit("\u0000")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            hosts = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            lists = b.column(b.num_columns - 2).to_pylist()
            texts = b.column(at).to_pylist()
            for i, lost in enumerate(lists):
                if lost:
                    texts[i] = _without(texts[i], hosts[i], set(lost))
            cols = list(b.columns[: len(columns)])
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return others.unionByName(out.select(*columns, "__gone", host.alias("__host")).mapInArrow(strip, kind))


def _without(text: str, host: np.uint64, lost: set[int]) -> str:
    """The text without the lines whose (host, line) hash is in `lost`; lines without words stay."""
    lines = text.split("\n")
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x.encode("utf-8")) + 1 for x in lines])])
    off[-1] -= 1
    words, first, _, _ = word_hashes(_DIGIT[data], off, lower=True)
    h = mix64(run_hashes(words, first[:-1], first[1:]) ^ host).view(np.int64)
    return "\n".join(x for x, own, n in zip(lines, h, np.diff(first)) if not n or int(own) not in lost)
