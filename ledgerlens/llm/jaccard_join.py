"""Operator 7: exact Jaccard join of shingle sets as a metric-space join.

Jaccard distance is a metric, so |d(x, p) - d(y, p)| <= d(x, y) for any pivot
p. Two sets link when their distance is at most eps = 0.2.

1. Equal sets become one class, so copies cost nothing below.
2. Regions. In any fixed order of shingles, linked sets of sizes n and m share
   at least l = 1 + floor(SPARE * min(n, m)) of their first floor(eps * n) + l
   shingles (the prefix; common shingles come last in the order, which makes it
   selective). A set with fewer shared prefix shingles than its own size asks
   for links with nothing. Of the sets that hold a prefix shingle, the smallest class is the
   pivot; a set on the border of several regions is replicated into each. Far
   sets, at distance 1 from every pivot, belong to none.
3. Every member is compared with its pivots; those within eps link.
4. Members of one component are settled with one another, however far apart.
   The others are joined once, without further pivots: each open member of a
   region with the members, open or settled, inside its triangle-inequality and
   size windows, in cells of bounded size, exactly.

A region of copies, however large, is settled in step 3 but for the members on
its border. No step emits the pairs of a region.

Sets are known by 64-bit hashes of shingles and of whole sets: the chance that
two of n sets are confused is about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, mix64, run_hashes, slices, stored, text_chunks, word_hashes
from .components import components

WORDS = 5
PERCENT = 80
# A shingle in more than this share of the documents (and COMMON_LEAST of them) is ordered last.
COMMON_SHARE = 0.00005
COMMON_LEAST = 8
# Shingles of the undecided and of the other members in one cell of a split region.
CELL_OUTER, CELL_INNER = 250_000, 1_000_000
# Prefix shingles beyond the first shared one, as a share of the set.
SPARE = 0.1
# Bits of the map that spares the texts of far documents a shuffle; past some ten million regions' members it lets all through.
BITS = 1 << 25
# Shingles that a task counts at once to find the common ones.
RUN = 1_000_000

INDEX_SCHEMA = "doc_id long, n_shingles long, cls long, prefix array<long>"
CELL_SCHEMA = "a long, b long"
LIKELY_SCHEMA = "cls long, pivot long, label long, n long, d double, o long, i long, outer boolean, inner boolean"


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than `words` words form one shingle, none an empty set."""
    for a, b, data, off in text_chunks(texts):
        h, first, _, _ = word_hashes(data, off)
        grams = gram_hashes(h, words)
        whole = run_hashes(h, first[:-1], first[1:])
        for d in range(b - a):
            lo, hi = first[d], first[d + 1]
            if hi - lo >= words:
                yield np.unique(grams[lo : hi - words + 1])
            else:
                yield whole[d : d + 1] if hi > lo else whole[:0]


def _common(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles that two or more documents of a run hold, with their number; a run has RUN shingles."""
        held, size = [], 0
        for batch in slices(batches):
            for s in shingle_sets(batch.column(0), words):
                held.append(s.copy())
                size += len(s)
                if size >= RUN:
                    yield _twice(held)
                    held, size = [], 0
        if held:
            yield _twice(held)

    return count


def _twice(sets: list[np.ndarray]) -> pa.RecordBatch:
    u, n = np.unique(np.concatenate(sets), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(u[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], names=["s", "n"])


def set_class(s: np.ndarray) -> int:
    return int(run_hashes(s, np.zeros(1, np.int64), np.array([len(s)]))[:1].view(np.int64)[0])


def _index(words: int, percent: int, common: np.ndarray):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, size, class, prefix shingles) of each document."""
        for batch in slices(batches):
            n, cls, parts, off = [], [], [], [0]
            for s in shingle_sets(batch.column(1), words):
                take = len(s) - -(-percent * len(s) // 100) + 1 + int(SPARE * len(s)) if len(s) else 0
                if len(common) and take:
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    late = common[at] == s
                    chosen = np.concatenate([s[~late], s[late]])[:take]
                else:
                    chosen = s[:take]
                n.append(len(s))
                cls.append(set_class(s))
                parts.append(chosen)
                off.append(off[-1] + len(chosen))
            flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.view(np.int64)))],
                names=["doc_id", "n_shingles", "cls", "prefix"],
            )

    return index


def _bit(ids: pa.Array) -> np.ndarray:
    return (mix64(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(BITS)).astype(np.int64)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the bit map (place, mask) that the ids of a batch set."""
    for b in batches:
        bit = np.unique(_bit(b.column(0)))
        place, start = np.unique(bit >> 5, return_index=True)
        mask = np.bitwise_or.reduceat(np.int64(1) << (bit & 31), start) if len(bit) else bit
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(mask)], names=["place", "mask"])


def _maybe(bitmap: np.ndarray):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (doc_id, text) whose id may be in the bit map, and those without an id."""
        for b in batches:
            bit = _bit(b.column(0))
            hit = (bitmap[bit >> 5] >> (bit & 31)) & 1
            yield b.filter(pa.array((hit == 1) | pc.is_null(b.column(0)).to_numpy(zero_copy_only=False)))

    return keep


def _classes(words: int):
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cls = [set_class(s) for s in shingle_sets(b.column(0), words)]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), b.column(0)], names=["cls", "text"])

    return classes


def _shared(words: int):
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size of the intersection of the two sets of every pair (cls, pivot, n, pn, text, ptext)."""
        for b in slices(batches):
            pivots: dict[int, np.ndarray] = {}
            first = {p: i for i, p in enumerate(b.column(1).to_pylist())}
            for p, s in zip(first, shingle_sets(b.column(5).take(pa.array(list(first.values()), pa.int64())), words)):
                pivots[p] = s
            common = [
                len(np.intersect1d(s, pivots[p], assume_unique=True))
                for p, s in zip(b.column(1).to_pylist(), shingle_sets(b.column(4), words))
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(common, pa.int64())], names=["cls", "pivot", "n", "pn", "shared"])

    return shared


def _near(d: np.ndarray, dist: float, n: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Members inside the triangle-inequality and size windows of one; NaN distances bound nothing."""
    return ~(np.abs(d - dist) > 1 - percent / 100 + 1e-9) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))


class _Holders:
    """Inverted index over sorted arrays: how many elements each shares with another one."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.rows, self.n = flat[order], rows[order], len(sets)

    def shared(self, s: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.flat, s, "left"), np.searchsorted(self.flat, s, "right")
        k = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(k.sum())
        return np.bincount(self.rows[at], minlength=self.n)


def _likely(percent: int):
    def likely(cell: pa.Table) -> pa.Table:
        """Rows of a cell that share enough prefix shingles with another to link, without their hits.

        Rows: pivot, o, i, outer, inner, cls, label, n, d, hits (sorted shared prefix shingles).
        """
        hits = [np.array(h, dtype=np.int64).view(np.uint64) for h in cell.column("hits").to_pylist()]
        left, right = (np.flatnonzero(cell.column(c).to_numpy()) for c in ("outer", "inner"))
        cls, label, n, d = (cell.column(c).to_numpy() for c in ("cls", "label", "n", "d"))
        index = _Holders([hits[j] for j in right])
        spare = (SPARE * n).astype(np.int64)
        outer, inner = np.zeros(len(hits), bool), np.zeros(len(hits), bool)
        for x in left:
            near = (label[right] != label[x]) & (cls[right] != cls[x]) & _near(d[right], d[x], n[right], n[x], percent)
            if near.any():
                found = near & (index.shared(hits[x]) >= 1 + np.minimum(spare[right], spare[x]))
                outer[x] |= found.any()
                inner[right[found]] = True
        keep = outer | inner
        cell = cell.drop_columns(["hits", "outer", "inner"]).filter(pa.array(keep))
        cell = cell.append_column("outer", pa.array(outer[keep])).append_column("inner", pa.array(inner[keep]))
        return cell.select([c.split()[0] for c in LIKELY_SCHEMA.split(", ")])

    return likely


def _cell(percent: int, words: int):
    def join(cell: pa.Table) -> pa.Table:
        """Links between the undecided and the other members of one cell that connect two components.

        Rows: outer, inner (bool: on which sides of the join), cls, label, n, d
        (distance to the region's pivot, or NaN where sizes or prefixes keep them apart), text.
        """
        every = list(shingle_sets(cell.column("text"), words))
        left, right = (np.flatnonzero(cell.column(c).to_numpy()) for c in ("outer", "inner"))
        outer, inner = cell.take(pa.array(left)), cell.take(pa.array(right))
        sets = [every[i] for i in right]
        cls, label, n, d = (inner.column(c).to_numpy() for c in ("cls", "label", "n", "d"))
        label = label.copy()
        index = _Holders(sets)
        found = []
        now = {}
        for i, x, own, size, dist in zip(left, *(outer.column(c).to_pylist() for c in ("cls", "label", "n", "d"))):
            own = now.get(own, own)
            near = (label != own) & (cls != x) & _near(d, dist, n, size, percent)
            if not near.any():
                continue
            shared = index.shared(every[i])
            for j in np.flatnonzero(near & (100 * shared >= percent * (n + size - shared))):
                if label[j] == own:
                    continue
                found.append((x, int(cls[j])))
                old = label[j]
                label[label == old] = own
                for k_, v in list(now.items()):
                    if v == old:
                        now[k_] = own
                now[int(old)] = own
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return join


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    common_share: float = COMMON_SHARE, cell_outer: int = CELL_OUTER, cell_inner: int = CELL_INNER,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a set holds the
    distinct shingles of `words` words of the whole text. Documents link when
    100 * intersection >= percent * union; component_id is the smallest doc_id
    reachable by links.

    Edge cases: fewer words than a shingle form one shingle of all of them; a
    null text or one without words has an empty set and links with nothing;
    rows are told apart by their sets, so rows that share an id but not a text
    are judged each; null ids never are a component_id unless a component has no
    other; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    # common shingles: at most 1 / common_share times the mean set size, whatever the number of documents
    seen = rows.select("text").mapInArrow(_common(words), "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    n_docs = rows.count()
    often = seen.where(F.col("n") >= max(COMMON_LEAST, common_share * n_docs)).select("s").toArrow()
    common = np.sort(often.column("s").to_numpy().astype(np.int64).view(np.uint64))

    index = stored(rows.mapInArrow(_index(words, percent, common), INDEX_SCHEMA), "jaccard-index")
    posts = index.select("cls", F.col("n_shingles").alias("n"), F.explode("prefix").alias("shingle"))

    def pivots_of(p: DataFrame) -> DataFrame:
        """(shingle, pivot) of the shingles that two or more classes hold; pre-aggregated, so no shingle is too common."""
        return p.groupBy("shingle").agg(F.min("cls").alias("pivot"), F.max("cls").alias("top")).where("pivot < top").select("shingle", "pivot")

    hits = stored(posts.join(pivots_of(posts).select("shingle"), "shingle").distinct(), "jaccard-hits")
    asked = 1 + F.floor(SPARE * F.ceil(F.col("n") * percent / 100))
    near = hits.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= asked).select("cls", "n")
    near = stored(near, "jaccard-near")
    hits = hits.join(near.select("cls"), "cls", "left_semi")
    members = hits.join(pivots_of(hits), "shingle").where("cls <> pivot").select("pivot", "cls", "n").distinct()
    members = members.join(near.select(F.col("cls").alias("pivot"), F.col("n").alias("pn")), "pivot")
    members = stored(members, "jaccard-members")

    # the whole texts of these classes, from one document each
    wanted = members.select("cls").union(members.select(F.col("pivot").alias("cls"))).distinct()
    one = index.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("one"))
    one = stored(one.select(F.col("one").alias("__one")).distinct(), "jaccard-ids")
    words_set = one.mapInArrow(_bits, "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(BITS >> 5, dtype=np.int64)
    bitmap[words_set.column("place").to_numpy()] = words_set.column("mask").to_numpy()
    able = rows.mapInArrow(_maybe(bitmap), "doc_id long, text string")
    texts = able.join(one, F.col("doc_id").eqNullSafe(F.col("__one")), "left_semi").select("text")
    texts = stored(texts.mapInArrow(_classes(words), "cls long, text string"), "jaccard-texts")
    if texts.count() > texts.select("cls").distinct().count():  # rows that repeat id and text
        texts = stored(texts.dropDuplicates(["cls"]), "jaccard-texts")

    # sizes and too few shared prefix shingles keep many members from their pivots
    shared_hits = stored(hits.groupBy("cls").agg(F.array_sort(F.collect_list("shingle")).alias("hits")), "jaccard-prefixes")

    def both(rows: DataFrame, table: DataFrame, column: str, other: str) -> DataFrame:
        """`rows` with `column` of the member and, as `other`, of the pivot; both joins read one exchange of `table`."""
        got = rows.join(table, "cls").withColumnsRenamed({"cls": "x", column: "of_x", "pivot": "cls"})
        return got.join(table, "cls").withColumnsRenamed({"cls": "pivot", column: other, "x": "cls", "of_x": column})

    able = members.where(100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
    enough = F.size(F.array_intersect("hits", "phits")) >= 1 + F.floor(SPARE * F.least("n", "pn"))
    able = both(able, shared_hits, "hits", "phits").where(enough).select("cls", "pivot", "n", "pn")
    pairs = both(able, texts, "text", "ptext").select("cls", "pivot", "n", "pn", "text", "ptext")
    got = pairs.mapInArrow(_shared(words), "cls long, pivot long, n long, pn long, shared long")
    union = F.col("n") + F.col("pn") - F.col("shared")
    got = stored(got.select("cls", "pivot", (1 - F.col("shared") / union).alias("d"), (100 * F.col("shared") >= percent * union).alias("linked")), "jaccard-distances")
    labels = components(got.where("linked").select(F.col("cls").alias("a"), F.col("pivot").alias("b")))

    # regions that the pivots left open, within the windows of their open members
    by = lambda c, out: labels.select(F.col("node").alias(c), F.col("label").alias(out))
    state = members.join(by("cls", "label"), "cls", "left").join(by("pivot", "plabel"), "pivot", "left")
    state = state.withColumns({"label": F.coalesce("label", "cls"), "open": F.coalesce("label", "cls") != F.coalesce("plabel", "pivot")})
    state = state.join(got.select("cls", "pivot", "d"), ["cls", "pivot"], "left").withColumn("d", F.coalesce("d", F.lit(float("nan"))))
    open_ = stored(state.select("pivot", "cls", "n", "d", "label", "open"), "jaccard-open")
    eps = 1 - percent / 100
    of = open_.where("open").groupBy("pivot").agg(
        F.sum("n").alias("outer_n"), F.min("d").alias("d0"), F.max("d").alias("d1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    # NaN is the largest number: a region with an open member of unknown distance has no upper bound
    inside = open_.join(of, "pivot").where(
        (F.col("open") | F.isnan("d") | F.isnan("d1") | ((F.col("d") >= F.col("d0") - eps - 1e-9) & (F.col("d") <= F.col("d1") + eps + 1e-9)))
        & (100 * F.col("n") >= percent * F.col("n0")) & (percent * F.col("n") <= 100 * F.col("n1")))
    # a link needs an open member and one of another label, open or settled, of a size near its own: settled members
    # need an open one beside them, open ones any of another label
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) + 1e-12))
    inside = inside.withColumn("band", band)
    beside = inside.groupBy("pivot", "band").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.max("open").alias("any_open"))
    beside = beside.withColumn("band", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])))
    beside = beside.groupBy("pivot", "band").agg(F.min("l0").alias("l0"), F.max("l1").alias("l1"), F.max("any_open").alias("any_open"))
    able = F.when(F.col("open"), (F.col("l0") != F.col("label")) | (F.col("l1") != F.col("label"))).otherwise(F.col("any_open"))
    inside = stored(inside.join(beside, ["pivot", "band"]).where(able).drop("band", "l0", "l1", "any_open"), "jaccard-inside")
    total = inside.groupBy("pivot").agg(F.sum("n").alias("inner_n"), F.count(F.lit(1)).alias("m")).where("m > 1")
    inside = inside.join(total.select("pivot", "inner_n"), "pivot")
    blocks = lambda c, size: F.ceil(F.col(c) / F.lit(float(size)))
    inside = inside.withColumns({"ob": blocks("outer_n", cell_outer), "ib": blocks("inner_n", cell_inner)})
    place = lambda b: F.pmod(F.xxhash64("cls"), F.col(b))
    every = lambda b: F.explode(F.sequence(F.lit(0).cast("long"), F.col(b) - 1))
    small = (F.col("ob") == 1) & (F.col("ib") == 1)
    keep = ("pivot", "cls", "label", "n", "d")
    zero = F.lit(0).cast("long")
    whole = inside.where(small).select(*keep, F.col("open").alias("outer"), F.lit(True).alias("inner"), zero.alias("o"), zero.alias("i"))
    outer = inside.where(~small & F.col("open")).select(*keep, F.lit(True).alias("outer"), F.lit(False).alias("inner"), place("ob").alias("o"), every("ib").alias("i"))
    inner = inside.where(~small).select(*keep, F.lit(False).alias("outer"), F.lit(True).alias("inner"), every("ob").alias("o"), place("ib").alias("i"))
    cells = whole.unionByName(outer).unionByName(inner)
    # first by the few shared prefix shingles of each, then by the texts of those left
    likely = cells.join(shared_hits, "cls").groupBy("pivot", "o", "i").applyInArrow(_likely(percent), LIKELY_SCHEMA)
    likely = stored(likely, "jaccard-likely")
    second = likely.join(texts, "cls").groupBy("pivot", "o", "i").applyInArrow(_cell(percent, words), CELL_SCHEMA)
    second = stored(second, "jaccard-links")

    # labels stand for their members: only links between components are left
    moved = second.join(by("a", "la"), "a", "left").join(by("b", "lb"), "b", "left")
    moved = moved.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    higher = components(moved)
    top = higher.select(F.col("node").alias("label"), F.col("label").alias("top"))
    all_nodes = labels.unionByName(higher.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label")))
    final = all_nodes.join(top, "label", "left").select(F.col("node").alias("cls"), F.coalesce("top", "label").alias("label"))

    full = index.where("n_shingles > 0")
    least = full.groupBy("cls").agg(F.min("doc_id").alias("least")).join(final, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    ids = least.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = least.join(ids, "label").select("cls", "component_id")
    linked = full.join(of_class, "cls").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(index.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents with the smallest id of their group, and those without words; columns as in `docs`.

    Ids should be unique: of rows that share id and text one stays; rows that
    share an id only stay together if one of them is its group's smallest.
    """
    groups = jaccard_groups(docs, id_col, text_col, **options)
    keep = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    out = docs.join(keep, docs[id_col].eqNullSafe(F.col("__id")))
    single = out.where("__n = 1").select(*[docs[c] for c in docs.columns])
    several = out.where("__n > 1").select(*[docs[c] for c in docs.columns]).dropDuplicates([id_col, text_col])
    return single.unionByName(several)
