"""Operator 12: ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to owners, rare terms to the first. Documents are dealt to blocks and items to
bundles; a bundle's cell of one block holds, for each item, a sparse set of
accumulators (document, score so far). The cells visit the owners one after
another: each stage cogroups them with the owner's postings of the block and
adds integer contributions. Ten documents of each item are selected at the end.

No posting list, item or document set ever forms one group: a group is a cell,
at most about BLOCK_DOCS documents by BUNDLE_ITEMS items, whatever the number
of documents that share a term. Between stages an accumulator goes
only if its score and the most that later owners can add stay below a score
that ten documents of its item already reach, so results are exact.

Edge cases: a null or empty text has no term; a document without any does not
count in N; documents or items that share an id are rows each, and equal scores
go by doc_id (null last), then row; an item without terms, or whose terms occur
nowhere, has no result; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TOP = 10
OWNERS = 4
BLOCK_DOCS = 2048
BUNDLE_ITEMS = 256
# Bits of the table of item-term checksums that documents' terms are first held against: its size is fixed.
FILTER_BITS = 24

# Letters and digits of ASCII and every byte of other characters, after A-Z are lower-cased.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

DOC_SCHEMA = "row long, doc_id long, n long, terms array<string>, tfs array<long>"
ACC = "struct<row: long, doc_id: long, score: long>"
CELL_SCHEMA = (
    "block long, bundle long, item long, item_id long, terms array<struct<t: long, w: long, owner: long>>, "
    f"rest array<long>, floor long, acc array<{ACC}>, best array<long>"
)
_TERMS = pa.list_(pa.struct([("t", pa.int64()), ("w", pa.int64()), ("owner", pa.int64())]))
_ACC = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))
CELL_ARROW = pa.schema([
    ("block", pa.int64()), ("bundle", pa.int64()), ("item", pa.int64()), ("item_id", pa.int64()), ("terms", _TERMS),
    ("rest", pa.list_(pa.int64())), ("floor", pa.int64()), ("acc", _ACC), ("best", pa.list_(pa.int64()))])


def term_counts(rows: DataFrame, wanted=None) -> DataFrame:
    """DOC_SCHEMA rows of (row, doc_id, text): number of terms, distinct terms and their counts.

    `wanted`, a broadcast bit table over checksums of terms, leaves out the terms that are not in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = (wanted.value, (1 << FILTER_BITS) - 1) if wanted is not None else (None, 0)
        for b in batches:
            n, terms, tfs = [], [], []
            for text in b.column(2):
                found = _TERM.findall(text.as_py().encode("utf-8").lower()) if text.is_valid else []
                n.append(len(found))
                counts = Counter(found)
                if bits is not None:
                    counts = {t: k for t, k in counts.items() if bits[zlib.crc32(t) & mask]}
                terms.append([t.decode("utf-8") for t in counts])
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, DOC_SCHEMA)


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _owner_limits(per_df: list[tuple[int, int]], owners: int) -> list[int]:
    """Largest df class of each owner but the last, so that owners hold about equal numbers of postings."""
    total, run, limits = sum(k for _, k in per_df), 0, []
    for cls, k in sorted(per_df):
        run += k
        while len(limits) < owners - 1 and run * owners >= total * (len(limits) + 1):
            limits.append(cls)
    return limits + [10**9] * (owners - 1 - len(limits))


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    top: int = TOP, owners: int = OWNERS, block_docs: int = BLOCK_DOCS, bundle_items: int = BUNDLE_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of every item."""
    spark = docs.sparkSession
    queries = stored(term_counts(_rows(items, item_col, item_text_col)), "search-items")
    asked = queries.select("row", F.col("doc_id").alias("item_id"), F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    asked = asked.select("row", "item_id", F.col("x.terms").alias("term"), F.col("x.tfs").alias("reps"))
    slots = asked.select(F.crc32(F.col("term").cast("binary")).bitwiseAND((1 << FILTER_BITS) - 1).alias("slot")).distinct().toPandas()["slot"]
    bits = np.zeros(1 << FILTER_BITS, dtype=np.bool_)
    bits[slots.to_numpy(dtype=np.int64)] = True
    wanted = spark.sparkContext.broadcast(bits.tobytes())
    counted = stored(term_counts(_rows(docs, id_col, text_col), wanted), "search-docs")
    size = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n_docs"), F.sum("n").alias("n_terms"), F.count(F.lit(1)).alias("n_rows")).first()
    n_docs, n_terms, n_blocks = size["n_docs"], size["n_terms"] or 1, -(-size["n_rows"] // block_docs) or 1
    postings = _postings(counted, n_docs, n_terms, n_blocks)
    terms = _terms(postings, asked, n_docs, owners)
    cells, held = _cells(asked, terms, queries.count(), n_blocks, owners, bundle_items)
    # the owner of a term holds its postings; a posting goes to the bundles that ask for its term
    owned = postings.join(held, "term").select("block", "bundle", "owner", "t", "row", "doc_id", "gain")
    owned = stored(owned.repartition("block", "bundle"), "search-postings")
    for owner in range(owners):
        part = owned.where(F.col("owner") == owner).drop("owner")
        step = cells.groupBy("block", "bundle").cogroup(part.groupBy("block", "bundle")).applyInArrow(_stage(owner, top), CELL_SCHEMA)
        cells = stored(step, f"search-stage-{owner}")
        if owner < owners - 1:
            cells = _raised(cells, top, owner, n_blocks)
    return _select(cells, top, n_blocks)


def _postings(counted: DataFrame, n_docs: int, n_terms: int, n_blocks: int) -> DataFrame:
    """(term, block, row, doc_id, gain): gain is the contribution of a term of weight 1."""
    m = F.expr(f"25 + (75L * n * {n_docs}L) div {n_terms}L")
    p = counted.where("n > 0").select("row", "doc_id", m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    return p.select(
        F.col("x.terms").alias("term"), F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block"), "row", "doc_id",
        F.expr("(1000000000L * x.tfs) div (1000L * x.tfs + 8L * m)").alias("gain"))


def _terms(postings: DataFrame, asked: DataFrame, n_docs: int, owners: int) -> DataFrame:
    """(term, t, w, most, owner) of every term of the items: number, weight, largest gain, owner."""
    found = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("gain").alias("most"))
    terms = asked.select("term").distinct().join(found, "term")
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    # eighths of the powers of two
    terms = terms.withColumns({"w": w.cast("long"), "cls": F.floor(8 * F.log2("df")), "t": F.monotonically_increasing_id()})
    terms = stored(terms, "search-terms")
    limits = _owner_limits([(r["cls"], r["k"]) for r in terms.groupBy("cls").agg(F.sum("df").alias("k")).collect()], owners)
    owner = reduce(lambda c, x: c + (F.col("cls") > x).cast("long"), limits, F.lit(0).cast("long"))
    return terms.select("term", "t", "w", "most", owner.alias("owner"))


def _cells(asked: DataFrame, terms: DataFrame, n_items: int, n_blocks: int, owners: int, bundle_items: int) -> tuple[DataFrame, DataFrame]:
    """The first cells (every item in every block, no accumulators), and (term, t, owner, bundle) of the bundles' terms."""
    bundle = F.pmod(F.xxhash64("row"), F.lit(-(-n_items // bundle_items) or 1))
    known = asked.join(terms, "term").withColumns({"bundle": bundle, "weight": F.col("w") * F.col("reps")})
    rest = [F.coalesce(F.sum(F.when(F.col("owner") > o, F.col("weight") * F.col("most"))), F.lit(0).cast("long")) for o in range(owners)]
    per_item = known.groupBy("bundle", F.col("row").alias("item"), "item_id").agg(
        F.collect_list(F.struct("t", F.col("weight").alias("w"), "owner")).alias("terms"), F.array(*rest).alias("rest"))
    per_item = stored(per_item, "search-cells")
    empty = {"floor": F.lit(0).cast("long"), "acc": F.expr(f"cast(array() as array<{ACC}>)"), "best": F.expr("cast(array() as array<long>)")}
    cells = per_item.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))).withColumns(empty)
    names = [f.strip() for f in "block, bundle, item, item_id, terms, rest, floor, acc, best".split(",")]
    return cells.select(*names), known.select("term", "t", "owner", "bundle").distinct()


def _ranked(ids: np.ndarray, null: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.lexsort((rows, ids, null, -scores))


def _stage(owner: int, top: int):
    """The cogrouped step of one owner: a cell's accumulators plus the gains of its postings."""

    def run(cells: pa.Table, postings: pa.Table) -> pa.Table:
        if not cells.num_rows:
            return CELL_ARROW.empty_table()
        col = lambda name: postings.column(name).to_numpy()
        t = col("t")
        order = np.argsort(t, kind="stable")
        t, gain = t[order], col("gain")[order]
        held = cells.column("acc").combine_chunks()
        old = held.flatten()
        old_rows, old_scores = old.field("row").to_numpy(zero_copy_only=False), old.field("score").to_numpy(zero_copy_only=False)
        # every document of the cell once: by row, with its id
        all_rows = np.concatenate([col("row"), old_rows])
        rows, first = np.unique(all_rows, return_index=True)
        new_ids = postings.column("doc_id").combine_chunks()
        ids = pa.concat_arrays([new_ids if isinstance(new_ids, pa.Array) else new_ids.combine_chunks(), old.field("doc_id")]).take(pa.array(first))
        null, id_values = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.searchsorted(rows, col("row"))[order]
        old_at, bounds = np.searchsorted(rows, old_rows), np.concatenate([[0], np.cumsum(held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        out = {name: [] for name in ("terms", "acc", "best")}
        queries = cells.select(["terms", "rest", "floor"]).to_pylist()
        for k, q in enumerate(queries):
            score = np.zeros(len(rows), np.int64)
            score[old_at[bounds[k] : bounds[k + 1]]] = old_scores[bounds[k] : bounds[k + 1]]
            for term in q["terms"]:
                if term["owner"] == owner:
                    lo, hi = np.searchsorted(t, [term["t"], term["t"] + 1])
                    # a document holds a term once: no index occurs twice
                    score[at[lo:hi]] += term["w"] * gain[lo:hi]
            rest = q["rest"][owner]
            live = np.flatnonzero((score > 0) & (score + rest >= q["floor"]))
            best = -np.sort(-score[live])[:top]
            if len(best) == top:
                # what ten documents of this block reach bounds the block as well
                live = live[score[live] + rest >= best[-1]]
            if rest == 0:
                live = live[_ranked(id_values[live], null[live], rows[live], score[live])[:top]]
            out["terms"].append([x for x in q["terms"] if x["owner"] > owner])
            out["best"].append(best.tolist())
            out["acc"].append(pa.StructArray.from_arrays(
                [pa.array(rows[live]), pa.array(id_values[live], mask=null[live]), pa.array(score[live])], names=["row", "doc_id", "score"]))
        sizes = np.concatenate([[0], np.cumsum([len(a) for a in out["acc"]])])
        acc = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.concat_arrays(out["acc"]))
        same = {c: cells.column(c) for c in ("block", "bundle", "item", "item_id", "rest", "floor")}
        done = same | {"terms": pa.array(out["terms"], _TERMS), "acc": acc, "best": pa.array(out["best"], pa.list_(pa.int64()))}
        return pa.table([done[f.name] for f in CELL_ARROW], names=CELL_ARROW.names).cast(CELL_ARROW)

    return run


def _spread(n_blocks: int) -> Column:
    """Blocks in about sqrt(n_blocks) groups: the middle level of a two-level selection."""
    return F.pmod(F.xxhash64("block"), F.lit(int(np.ceil(np.sqrt(n_blocks)))))


def _raised(cells: DataFrame, top: int, owner: int, n_blocks: int) -> DataFrame:
    """Cells with `floor` raised to the score that `top` documents of the item reach, without accumulators that cannot get there."""
    best = lambda c: F.slice(F.sort_array(F.collect_list(c), asc=False), 1, top)
    scores = cells.select("item", _spread(n_blocks).alias("g"), F.explode("best").alias("score"))
    part = scores.groupBy("item", "g").agg(best("score").alias("best"))
    whole = part.select("item", F.explode("best").alias("score")).groupBy("item").agg(best("score").alias("best"))
    floors = stored(whole.where(F.size("best") == top).select("item", F.get("best", F.lit(top - 1)).alias("reached")), "search-floors")
    raised = cells.join(floors, "item", "left").withColumn("floor", F.greatest("floor", F.coalesce("reached", F.lit(0).cast("long")))).drop("reached")
    rest = F.get("rest", F.lit(owner))
    raised = raised.withColumn("acc", F.filter("acc", lambda a: a["score"] + rest >= F.col("floor")))
    # a cell without accumulators goes on only if later owners alone may still reach the floor
    alive = (F.size("acc") > 0) | ((rest > 0) & (rest >= F.col("floor")))
    return raised.where(alive).select(*CELL_ARROW.names)


def _select(cells: DataFrame, top: int, n_blocks: int) -> DataFrame:
    """The `top` accumulators of each item, first within groups of blocks."""
    found = cells.select("item", "item_id", _spread(n_blocks).alias("g"), F.explode("acc").alias("a")).select("item", "item_id", "g", "a.*")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    part = found.withColumn("k", F.row_number().over(Window.partitionBy("item", "g").orderBy(*order))).where(F.col("k") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
