"""Corpus operators against brute force on small data."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm.jaccard_join import jaccard_groups
from ledgerlens.llm.line_rules import line_rules
from ledgerlens.llm.toxicity import score_toxicity
from conftest import SF_MID, SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    own = list({s for s in sets if s})
    up = list(range(len(own)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in enumerate(own):
        for x in s:
            holders[x].append(i)
    shared = collections.Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(own[a]) + len(own[b]) - n):
            up[top(a)] = top(b)
    at = {s: i for i, s in enumerate(own)}
    least = {}
    for (i, _), s in zip(rows, sets):
        if s:
            least[top(at[s])] = min(i, least.get(top(at[s]), i))
    return sorted((i, len(s), least[top(at[s])] if s else i) for (i, _), s in zip(rows, sets))


def near_copies(n, seed):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(3000)}" for _ in range(200)] for _ in range(3)]
    rows = []
    for i in range(n):
        b = list(base[i % 3])
        for _ in range(rnd.randrange(0, 10)):
            b[rnd.randrange(len(b))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(b)))
    return rows


def test_jaccard_groups_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, jaccard_groups(df).collect())) == brute_groups([tuple(r) for r in df.collect()])


def test_jaccard_groups_on_borderline_copies_in_small_cells(spark):
    rows = near_copies(300, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    exp = brute_groups(rows)
    assert sorted(map(tuple, jaccard_groups(df, cell_outer=2000, cell_inner=3000).collect())) == exp
    assert 3 < len({r[2] for r in exp}) < 300


def nested_chains(n, seed):
    """Texts that shrink from one end in steps that link, while the first and the third do not."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        w = [f"c{c}w{rnd.randrange(10**6)}" for _ in range(124)]
        cuts = (124, 104, 86) if c % 2 else (124, 104, 86, 73)
        rows += [(10 * c + k, " ".join(w[:size] if c % 3 else w[-size:])) for k, size in enumerate(cuts)]
    return rows


def test_jaccard_groups_links_through_settled_members(spark):
    rows = nested_chains(60, 11)
    exp = brute_groups(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[2] for r in exp} == {10 * c for c in range(60)}
    assert sorted(map(tuple, jaccard_groups(df).collect())) == exp
    assert sorted(map(tuple, jaccard_groups(df, cell_outer=150, cell_inner=200).collect())) == exp


def test_line_rule_measures(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in line_rules(df).collect()}
    for d in df.collect():
        t = d["text"] or ""
        w = WORD.findall(t)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = collections.Counter(tri)
        covered = {j for i, g in enumerate(tri) if n[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
        assert (r["n_symbols"], r["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_toxicity_orders_held_out_documents(spark):
    d, lab = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(d, lab).where("held_out").join(lab, "doc_id").select("score", "toxic").collect()
    pos, neg = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.75


def _plain_alignment(a, b):
    """Best score and end of a Smith-Waterman table filled cell by cell."""
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = (0, 0, 0)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = max(0, t[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), t[i - 1][j] - 1, t[i][j - 1] - 1)
            if t[i][j] > best[0]:
                best = (t[i][j], i, j)
    return best


def _plain_run(a, b):
    return max((k for i in range(len(a)) for j in range(len(b)) for k in range(1, min(len(a) - i, len(b) - j) + 1)
                if list(a[i:i + k]) == list(b[j:j + k])), default=0)


@pytest.mark.parametrize("cells", [30, 200_000])
def test_tables_of_many_pairs_equal_plain_alignments(monkeypatch, cells):
    from ledgerlens.llm import decontaminate as D

    monkeypatch.setattr(D, "TABLE_CELLS", cells)
    rng = np.random.default_rng(4)
    pairs = [(rng.integers(0, 6, rng.integers(0, 14)).astype(np.uint64), rng.integers(0, 6, rng.integers(0, 20)).astype(np.uint64))
             for _ in range(120)]
    got = D.align(pairs)
    assert got == [_plain_alignment(a, b) for a, b in pairs]
    assert D.longest_run(pairs) == [_plain_run(a, b) for a, b in pairs]
    ends = [(a[:i], b[:j]) for (a, b), (_, i, j) in zip(pairs, got)]
    for (a, b), (score, _, _), (m, n) in zip(ends, got, D.span(ends, [g[0] for g in got])):
        if score:
            # the spanned words alone give the same score, and end to end
            assert _plain_alignment(a[len(a) - m:], b[len(b) - n:]) == (score, m, n)


def test_template_items_are_followed_in_ranges(monkeypatch):
    from ledgerlens.llm import decontaminate as D

    template = [f"t{i}" for i in range(12)]
    own = lambda k, n: [f"own{k}x{i}" for i in range(n)]
    # items 0 and up hold 28 words of their own (the template alone is no copy), items 1000 and up hold 8 (it is)
    texts = [" ".join(template + own(k, 28)) for k in range(1000)] + [" ".join(template + own(k, 8)) for k in range(1000, 1200)]
    doc = " ".join(w for j in range(50) for w in template + own(-1 - j, 14)) + " " + " ".join(own(7, 28))
    items = D.Items(list(range(1200)), texts)
    items.keep_rare({})
    whole = sorted(D.find(pa.array([None, doc, ""], pa.string()), items))
    assert [(d, t) for d, t, _, _ in whole] == [(1, 7)] + [(1, t) for t in range(1000, 1200)]
    monkeypatch.setattr(D, "POSTINGS", 5_000)
    assert sorted(D.find(pa.array([None, doc, ""], pa.string()), items)) == whole
