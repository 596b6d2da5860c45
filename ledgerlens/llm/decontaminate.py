"""Operator 9: benchmark decontamination by rare n-gram seeds and local alignment.

1. The corpus occurrences of every n-gram of the test items are counted over
   all documents; the rarest two thirds of each item's n-grams are its seeds
   (relative to the item, so an item that leaked into very many documents keeps seeds),
   and of any three in a row the rarest, so that each passage has some.
2. A document that holds a seed is aligned with the seed's item: Smith-Waterman
   over words in a window around the seeds (match +2, other word or gap -1).
   An item is found where its alignments, which overlap neither in the document
   nor in the item, reach MIN_SHARE of the score of a full copy; also where one of
   them has the score of PASSAGE_WORDS words and MIN_SHARE of a full copy of the
   words it spans, or where so many words stand in a row.

Documents never move: both steps are one pass over the scan each, against a
block of test items held by every task. Blocks have a bounded number of words;
a larger benchmark takes more passes, not more memory. Alignments are filled row by
row for many pairs at once, so a seed that very many items share costs table cells only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, stored, text_chunks, word_count, word_hashes

SEED_WORDS = 3
SEED_SHARE = 2 / 3
MATCH, MISS, GAP = 2, -1, 1
MIN_SHARE = 0.5
# An alignment counts from this many matched words' score on (or the whole of a shorter item).
MIN_MATCHES = 8
# A passage of an item counts from this many matched words' score on, whatever the item's length.
PASSAGE_WORDS = 13
# Words of test items that a pass holds at once.
BLOCK_WORDS = 2_000_000
# Cells of a row of alignment tables that are filled together, and (seed, item) pairs followed at a time.
TABLE_CELLS = 200_000
POSTINGS = 1_000_000
ITEMS_AT_ONCE = 1000

FOUND_SCHEMA = "doc_id long, item_id long, score double, at_word long"

# ASCII punctuation separates words too: copies often differ in it
_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 32


class Items:
    """A block of test items as word hashes, with an index from seed n-grams to (item, position)."""

    def __init__(self, ids: list[int], texts: list[str | None], n: int = SEED_WORDS):
        self.n, self.ids, self.words = n, ids, []
        for _, _, data, off in text_chunks(pa.array(texts, pa.string())):
            h, first, _, _ = word_hashes(_PLAIN[data], off)
            self.words += [h[a:b] for a, b in zip(first[:-1], first[1:])]
        grams = [gram_hashes(w, n) for w in self.words]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        self.place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.gram, self.item, self.place = flat[order], self.item[order], self.place[order]
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self._index()

    def _index(self) -> None:
        # number of the n-gram, and a key that rises with (n-gram, item)
        self.rank = np.cumsum(np.diff(self.gram, prepend=self.gram[:1]) != 0)
        self.key = self.rank * len(self.words) + self.item

    def keep_rare(self, counts: dict[int, int], share: float = SEED_SHARE) -> None:
        """Keep of every item the given share of its n-grams, the rarest first (ties with the last one stay), and the rarest of
        any n in a row: a passage that very many documents quote keeps seeds though the rest of its item is rarer."""
        c = np.array([counts.get(int(g), 0) for g in self.gram.view(np.int64)])
        keep = np.zeros(len(c), dtype=bool)
        by = np.argsort(self.item, kind="stable")
        for rows in np.split(by, np.flatnonzero(np.diff(self.item[by])) + 1) if len(by) else []:
            keep[rows] = c[rows] <= np.sort(c[rows])[int(np.ceil(len(rows) * share)) - 1]
            rows = rows[np.lexsort((c[rows], self.place[rows] // self.n))]
            keep[rows[np.flatnonzero(np.diff(self.place[rows] // self.n, prepend=-1))]] = True
        self.gram, self.item, self.place = self.gram[keep], self.item[keep], self.place[keep]
        self._index()

    def seeds(self) -> np.ndarray:
        return np.unique(self.gram)


Pair = tuple[np.ndarray, np.ndarray]


def _tables(pairs: list[Pair]) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Pairs of (item words, document words) in tables of bounded size, longest items first.

    Yields the pairs' numbers, for each item place the words of the items that have it, the document
    words in one row a pair, and the steps of a row. Document rows end in a word that no item holds.
    """
    order = sorted(range(len(pairs)), key=lambda k: (-len(pairs[k][0]), -len(pairs[k][1])))
    pos = 0
    while pos < len(order):
        some, width = [], len(pairs[order[pos]][0])
        while pos < len(order) and (not some or max(width, len(pairs[order[pos]][1])) * (len(some) + 1) <= TABLE_CELLS):
            some.append(order[pos])
            width = max(width, len(pairs[order[pos]][1]))
            pos += 1
        used = np.unique(np.concatenate([pairs[k][0] for k in some]))
        fill = np.setdiff1d(np.arange(len(used) + 1, dtype=np.uint64), used)[0]
        docs = np.full((len(some), width), fill, dtype=np.uint64)
        for r, k in enumerate(some):
            docs[r, : len(pairs[k][1])] = pairs[k][1]
        sizes = np.array([len(pairs[k][0]) for k in some])
        words = np.zeros((len(some), sizes[0]), dtype=np.uint64)
        words[np.arange(sizes[0]) < sizes[:, None]] = np.concatenate([pairs[k][0] for k in some])
        places = [words[: np.searchsorted(-sizes, -i), i] for i in range(sizes[0])]
        yield np.array(some), places, docs, (GAP * np.arange(width + 1)).astype(np.int32)


def _next_row(row: np.ndarray, words: np.ndarray, docs: np.ndarray, steps: np.ndarray, edge: int, floor: int | None) -> np.ndarray:
    """The next row of the alignment tables: one more item word, in all of them at once."""
    new = np.empty_like(row)
    new[:, 0] = edge
    np.maximum(row[:, :-1] + np.where(docs == words[:, None], np.int32(MATCH), np.int32(MISS)), row[:, 1:] - GAP, out=new[:, 1:])
    if floor is not None:
        np.maximum(new, floor, out=new)
    # gaps within the row: the best start to the left less its distance
    new += steps
    return np.maximum.accumulate(new, axis=1) - steps


def align(pairs: list[Pair]) -> list[tuple[int, int, int]]:
    """Best Smith-Waterman score of every pair of word sequences and the item and document words it ends at."""
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(pairs)
    for some, places, docs, steps in _tables(pairs):
        row = np.zeros((len(some), len(steps)), dtype=np.int32)
        got = np.zeros((len(some), 3), dtype=np.int64)
        for i, words in enumerate(places, 1):
            n = len(words)
            row = _next_row(row[:n], words, docs[:n], steps, 0, 0)
            j = row.argmax(axis=1)
            value = row[np.arange(n), j]
            more = np.flatnonzero(value > got[:n, 0])
            got[more, 0], got[more, 1], got[more, 2] = value[more], i, j[more]
        for k, g in zip(some.tolist(), got.tolist()):
            out[k] = tuple(g)
    return out


def span(pairs: list[Pair], scores: list[int]) -> list[tuple[int, int]]:
    """Words of the item and of the document that the alignment of the given score spans which ends both, for every pair."""
    out = [(len(a), len(b)) for a, b in pairs]
    for some, places, docs, steps in _tables([(a[::-1], b[::-1]) for a, b in pairs]):
        row = np.tile(-steps, (len(some), 1))
        want = np.array([scores[k] for k in some])
        todo = np.ones(len(some), dtype=bool)
        for i, words in enumerate(places, 1):
            n = len(words)
            row = _next_row(row[:n], words, docs[:n], steps, -GAP * i, None)
            for r in np.flatnonzero(todo[:n] & (row.max(axis=1) >= want[:n])):
                out[some[r]] = (i, int(row[r].argmax()))
                todo[r] = False
    return out


def longest_run(pairs: list[Pair]) -> list[int]:
    """Most words in a row that both sequences of a pair hold."""
    out = [0] * len(pairs)
    for some, places, docs, steps in _tables(pairs):
        row = np.zeros((len(some), len(steps)), dtype=np.int32)
        best = np.zeros(len(some), dtype=np.int64)
        for words in places:
            n = len(words)
            run = np.zeros_like(row[:n])
            run[:, 1:] = np.where(docs[:n] == words[:, None], row[:n, :-1] + 1, 0)
            row = run
            best[:n] = np.maximum(best[:n], row.max(axis=1))
        for k, v in zip(some.tolist(), best.tolist()):
            out[k] = v
    return out


def _apart(parts: list[tuple[int, int, int, int, int]]) -> int:
    """Summed score of alignments (score, item from and to, document from and to), best first, that overlap in neither."""
    taken: list[tuple[int, int, int, int, int]] = []
    for p in sorted(parts, reverse=True):
        if all((p[2] <= q[1] or q[2] <= p[1]) and (p[4] <= q[3] or q[4] <= p[3]) for q in taken):
            taken.append(p)
    return sum(p[0] for p in taken)


def _possible(items: Items, h: np.ndarray, first: np.ndarray, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which (document, item), in document and item order, share words enough to be found.

    No alignment, and no sum of alignments that do not overlap in the item, scores
    more than MATCH for each word of the item that the document holds anywhere.
    """
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
    ok = np.zeros(len(new), dtype=bool)
    starts = np.flatnonzero(np.diff(doc[new], prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(new))):
        d = doc[new[a]]
        held = np.unique(h[first[d]: first[d + 1]])
        for c in range(a, b, ITEMS_AT_ONCE):
            some = item[new[c:min(b, c + ITEMS_AT_ONCE)]]
            words = np.concatenate([items.words[t] for t in some])
            shared = held[np.minimum(np.searchsorted(held, words), len(held) - 1)] == words
            size = items.size[some]
            best = MATCH * np.add.reduceat(shared.astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]]))
            ok[c:c + len(some)] = best >= np.minimum(MATCH * PASSAGE_WORDS, MIN_SHARE * MATCH * size)
    return np.repeat(ok, np.diff(np.append(new, len(doc))))


def _found(items: Items, h: np.ndarray, first: np.ndarray, at: np.ndarray, doc: np.ndarray, item: np.ndarray,
           start: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    """(document, item, score, end word) of the items found in documents, from all seeds (place, document, item, item's start)."""
    order = np.lexsort((start, item, doc))
    at, doc, item, start = at[order], doc[order], item[order], start[order]
    size = items.size[item]
    # one window for each run of seeds of an item whose places agree within half its length
    new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(start) > size[1:] // 2)])
    cuts = np.flatnonzero(new)
    ends = np.append(cuts[1:], len(at)) - 1
    w0 = np.maximum(first[doc[cuts]], start[cuts] - size[cuts] // 2)
    w1 = np.minimum(first[doc[cuts] + 1], start[ends] + size[cuts] + size[cuts] // 2)
    keep = _possible(items, h, first, doc[cuts], item[cuts])
    cuts, w0, w1 = cuts[keep], w0[keep], w1[keep]
    aligned: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}
    pairs = [(items.words[t], h[x:y]) for t, x, y in zip(item[cuts], w0, w1)]
    for d, t, x, y, (score, last, end) in zip(doc[cuts].tolist(), item[cuts].tolist(), w0.tolist(), w1.tolist(), align(pairs)):
        if score >= min(MATCH * int(items.size[t]), MATCH * MIN_MATCHES):
            aligned.setdefault((d, t), []).append((score, last, x, y, x + end))
    unsure = []
    for (d, t), windows in aligned.items():
        full = MATCH * int(items.size[t])
        score, _, _, _, end = max(windows, key=lambda w: w[0])
        if score >= MIN_SHARE * full:
            yield d, t, score / full, int(end - first[d])
        elif score >= MATCH * PASSAGE_WORDS or sum(w[0] for w in windows) >= MIN_SHARE * full:
            unsure.append((d, t, score, end))
    each = [(t, *w) for d, t, _, _ in unsure for w in aligned[d, t]]
    spans = iter(span([(items.words[t][:last], h[x:stop]) for t, _, last, x, _, stop in each], [w[1] for w in each]))
    runs = iter(longest_run([(items.words[t], h[x:y]) if score >= MATCH * PASSAGE_WORDS else (items.words[t][:0], h[:0])
                             for t, score, _, x, y, _ in each]))
    for d, t, score, end in unsure:
        full = MATCH * int(items.size[t])
        hit, parts = False, []
        for value, last, _, _, stop in aligned[d, t]:
            (n_item, n_doc), run = next(spans), next(runs)
            parts.append((value, last - n_item, last, stop - n_doc, stop))
            if value >= MATCH * PASSAGE_WORDS:
                hit = hit or value >= MIN_SHARE * MATCH * max(n_item, n_doc) or run >= PASSAGE_WORDS
        score = max(score, _apart(parts))
        if hit or score >= MIN_SHARE * full:
            yield d, t, score / full, int(end - first[d])


def find(texts: pa.Array, items: Items) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, score, end word) of every item found in a text.

    Seeds that very many items share are followed for a range of items at a time, so memory does not grow with them.
    """
    n = items.n
    for a, b, data, off in text_chunks(texts):
        h, first, _, _ = word_hashes(_PLAIN[data], off)
        g = gram_hashes(h, n)
        lo, hi = np.searchsorted(items.gram, g, "left"), np.searchsorted(items.gram, g, "right")
        at = np.flatnonzero(hi > lo)
        doc = np.searchsorted(first, at, "right") - 1
        whole = at + n <= first[doc + 1]
        at, doc = at[whole], doc[whole]
        if not len(at):
            continue
        lo, hi = lo[at], hi[at]
        rounds = -(-int((hi - lo).sum()) // POSTINGS)
        key = items.rank[lo] * len(items.words)
        for r in range(rounds):
            if rounds > 1:
                ends = [key + len(items.words) * q // rounds for q in (r, r + 1)]
                lo, hi = (np.searchsorted(items.key, e, "left") for e in ends)
            k = hi - lo
            if not k.any():
                continue
            post = np.repeat(lo - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(k.sum())
            where, of = np.repeat(at, k), np.repeat(doc, k)
            for d, t, score, end in _found(items, h, first, where, of, items.item[post], where - items.place[post]):
                yield a + d, t, score, end


def _counts(seeds: np.ndarray, n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds), dtype=np.int64)
        for batch in batches:
            for _, _, data, off in text_chunks(batch.column(0)):
                h, first, _, _ = word_hashes(_PLAIN[data], off)
                g = gram_hashes(h, n)
                if len(g) and len(seeds):
                    at = np.minimum(np.searchsorted(seeds, g), len(seeds) - 1)
                    total += np.bincount(at[seeds[at] == g], minlength=len(seeds))
        hit = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(seeds[hit].view(np.int64)), pa.array(total[hit])], names=["gram", "n"])

    return count


def item_blocks(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """Blocks of test items with their rare seeds; each block is counted over all documents.

    Items without text, or with fewer words than a seed, cannot be told from
    ordinary prose and are left out.
    """
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    words = rows.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    blocks = max(1, -(-int(words) // block_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for i in range(blocks):
        got = rows.where(part == i).toArrow()
        items = Items(got.column(0).to_pylist(), got.column(1).to_pylist())
        seen = docs.mapInArrow(_counts(items.seeds(), items.n), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
        items.keep_rare(dict(zip(seen.column(0).to_pylist(), seen.column(1).to_pylist())))
        yield items


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, at_word) of every document and test item it holds a copy or a passage of.

    `score` is the alignments' share of a full copy's; `at_word` the document
    word at which the best one ends. Edge cases: null and empty texts hold nothing;
    repeated rows and repeated items are reported each; empty tables give no rows; null ids pass
    through; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in item_blocks(rows.select("text"), benchmark):

        def scan(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = list(find(b.column(1), items))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([f[0] for f in found], pa.int64())), pa.array([items.ids[f[1]] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64())],
                    names=["doc_id", "item_id", "score", "at_word"])

        part = stored(rows.mapInArrow(scan, FOUND_SCHEMA), "contaminated")
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no test item is found; columns as they are.

    Edge cases: null and empty texts hold no item and stay; repeated rows go or
    stay alike; null, empty and too short items are found nowhere; an empty table, of
    documents or of items, leaves the documents as they are.
    """
    at = docs.columns.index(text_col)
    for items in item_blocks(docs.select(F.col(text_col).cast("string")), benchmark):

        def keep(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = np.ones(b.num_rows, dtype=bool)
                ok[[f[0] for f in find(b.column(at).cast(pa.string()), items)]] = False
                yield b.filter(pa.array(ok))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
