"""Operators 11 to 13: brute force, exact round trips and odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pytest
from conftest import SF_SMALL
from ledgerlens.llm import token_output
from ledgerlens.llm.id_coder import decode_ids, encode_ids
from ledgerlens.llm.lexical_search import search
from ledgerlens.llm.queries import op11_token_ids, op13_whitened_embeddings
from ledgerlens.llm.token_output import PieceEncoder, read_tokens, token_ids
from ledgerlens.llm.whitening import whiten

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


# ---------------------------------------------------------------- operator 11


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 127, 128, 1000, 70_001])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for size, ids in (
        (50257, rng.integers(0, 50257, n)), (50257, np.zeros(n, int)), (50257, np.full(n, 50256)), (2, rng.integers(0, 2, n)),
        (50257, (rng.zipf(1.3, n) % 50257)),
    ):
        words, used = encode_ids(ids, size)
        assert (decode_ids(words, used, n, size) == ids).all()


def test_coder_learns_the_order_of_ids():
    ids = np.tile(np.random.default_rng(3).integers(0, 50257, 40), 5000)
    words, _ = encode_ids(ids, 50257)
    assert 16 * len(words) < 4 * len(ids)


def test_coder_keeps_one_stream_for_all_lanes():
    """Lanes differ by one state each; words belong to no lane, so a block ends where its last word was read."""
    ids = np.random.default_rng(4).zipf(1.2, 300_000) % 50257
    words, states = encode_ids(ids, 50257)
    assert states.dtype == np.uint64 and states.min() >= 1 << 24 and states.max() < 1 << 56
    assert (decode_ids(np.concatenate([words, words]), states, len(ids), 50257) == ids).all()


def test_pieces_equal_the_library_on_whole_texts(library):
    enc = PieceEncoder(BPE)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "é", " ", "　", "\x1c", ".", "1", "23", "<|endoftext|>", "\x85", "​", "日本", "\r\n", "\x0b", "x" * 80, "🙂"]
    rng = random.Random(5)
    for _ in range(1500):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3)]
        ids, counts = enc.run(pa.array(texts))
        want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
        assert ids.tolist() == [i for w in want for i in w], texts
        assert counts.tolist() == [len(w) for w in want]


def test_full_cache_keeps_the_pieces_of_several_runs(library, monkeypatch):
    monkeypatch.setattr(token_output, "CACHE_CHARS", 60)
    enc = PieceEncoder(BPE)
    often, texts = "x the same", ["x the same " + w * 9 for w in ("alpha", "beta", "gamma", "delta", "x\u3000 y", "omega")]
    for t in texts + texts[::-1]:
        ids, _ = enc.run(pa.array([t]))
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids + [0]
        held = len(enc.places)
        assert list(enc.places.values()) == list(range(held)) and enc.chars == sum(map(len, enc.places))
    monkeypatch.setattr(token_output, "CACHE_CHARS", 1000)
    enc._clear()
    for t in texts[:3]:
        enc.run(pa.array([t]))
    enc._trim()
    assert sorted(enc.places) == [" same", " the", " x"] and enc.uses[:3].tolist() == [0, 0, 0]
    assert enc.run(pa.array([often]))[0].tolist() == library.encode(often, add_special_tokens=False).ids + [0]


def test_spaces_for_arrow_are_those_of_python():
    pattern = re.compile(r"\s")
    odd = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and pattern.match(chr(c))]
    assert pc.match_substring_regex(pa.array([f"a {c}b" for c in odd] + [f"a{c} b" for c in odd]), token_output._MAYBE_WIDE).to_pylist() == [True] * 2 * len(odd)
    assert pc.match_substring_regex(pa.array(["a b", "a\nb\u3000c", "", "\u200b \u200b"]), token_output._MAYBE_WIDE).to_pylist() == [False] * 4


def _expected(rows, library):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_token_query_equals_brute_force(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(map(tuple, op11_token_ids(spark, SF_SMALL).collect()))
    assert got == [x[:4] for x in _expected(rows, library)]


def test_token_files_of_odd_rows_and_small_blocks(spark, library):
    long = "one two  three\n" * 400
    rows = [(5, "five", "x"), (None, "no id", "x"), (2, None, "x"), (3, "", "x"), (1, long, "x"), (5, "five", "x"), (-4, "minus", None), (9, "tail ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    got, index, folder = token_ids(docs, BPE, with_ids=True, block_ids=256, file_ids=600)
    ordered = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is None, r[0] or 0))
    assert sorted(map(tuple, (r[:1] + r[1:4] + (r[4],) for r in map(tuple, got.collect()))), key=lambda r: r[1]) == _expected(ordered, library)
    files = index.collect()
    assert sum(r["n_docs"] for r in files) == len(rows) and any(r["n_blocks"] > 3 for r in files)
    # a changed byte is found
    fs, inner = pafs.FileSystem.from_uri(folder)
    name = f"{inner}/{max(files, key=lambda r: r['n_bytes'])['file']}"
    with fs.open_input_file(name) as f:
        raw = bytearray(f.read())
    raw[len(raw) // 2] ^= 1
    with fs.open_output_stream(name) as f:
        f.write(bytes(raw))
    with pytest.raises(Exception, match="checksum"):
        read_tokens(index, folder).collect()


def test_token_output_of_an_empty_table(spark):
    got, index, _ = token_ids(spark.createDataFrame([], "doc_id long, text string"), BPE)
    assert got.count() == 0 and index.count() == 0


# ---------------------------------------------------------------- operator 12

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _search(docs, items, top=10):
    words = [WORD.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words)) or 1
    df = Counter(t for w in words for t in set(w))
    out = []
    for item_id, text in items:
        asked, scored = Counter(WORD.findall((text or "").translate(LOWER))), []
        for k, ((doc_id, _), w) in enumerate(zip(docs, words)):
            tf, m = Counter(w), 25 + (75 * len(w) * n_docs) // n_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t, r in asked.items() if tf[t])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def test_search_equals_brute_force_over_many_cells(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "日本", "A1"]
    text = lambda k: " ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(63)], k=k))
    docs = [(i, text(rng.randint(0, 40))) for i in range(300)] + [(7, "w1 w2"), (None, "w1 w2"), (None, "w1 w2"), (400, None), (401, ""), (402, "---")]
    # many equal texts: ties go by id
    docs += [(1000 + i, "w3 W4 w5") for i in range(40)]
    docs.append((403, " ".join(["w9"] * 5000)))
    items = [(i, text(8)) for i in range(12)] + [(3, "w3 w4 w5"), (None, "w1 w1 w2"), (20, None), (21, ""), (22, "nowhere")]
    d = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, row long").repartition(5)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    got = search(d, q, block_docs=25, bundle_items=4, owners=3)
    assert sorted(map(tuple, got.collect()), key=str) == _search(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_search_of_empty_tables(spark, docs, items):
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert search(d, q).count() == 0


# ---------------------------------------------------------------- operator 13


def _whitened(rows, weights="one", k=4):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(int(math.floor(256 * c)) for c in v) for _, v in rows]
    fit = Counter(x)
    u = np.array(list(fit))
    w = np.array(list(fit.values())) if weights == "count" else np.ones(len(u), int)
    n, s = int(w.sum()), w @ u
    c = u - s / n
    v = (c * w[:, None]).T @ c / n
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    share = e / np.trace(v) if np.trace(v) else None
    return [((rows[j][0], x[j]), n, sum((n * a - b) ** 2 for a, b in zip(x[j], s.tolist())), (np.array(x[j]) - s / n) @ vec, e, share) for j in range(len(rows))]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(spark, weights):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]
    # one vector of many rows
    rows += [(10_000 + i, rows[0][1]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in whiten(df, weights=weights).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["identity_error"] < 1e-9
    want = _whitened(rows, weights)
    assert len(got) == len(want)
    sign = None
    for (vec_id, _), n, deviation, raw, e, share in want:
        r = got[vec_id]
        w = np.array([r[c]["whitened"] for c in range(1, 5)])
        sign = np.sign(w * raw) if sign is None else sign
        assert np.allclose(w, sign * raw / np.sqrt(e), atol=1e-8) and np.allclose([r[c]["explained"] for c in range(1, 5)], share, rtol=1e-9)
        assert all(r[c]["n"] == n and r[c]["deviation"] == deviation for c in range(1, 5))


def test_whitening_query_has_a_row_for_each_vector_and_component(spark):
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert op13_whitened_embeddings(spark, SF_SMALL).count() == 4 * n


def test_whitening_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [3.0, 2.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [-inf, 1.0]), (9, [1.0, 2.0, 3.0]), (2, [-1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, whitened string")
    got = [tuple(r) for r in whiten(df).collect()]
    assert Counter(r[0] for r in got) == {1: 2, 2: 4, None: 2}
    first, second = [r for r in got if r[1] == 1], [r for r in got if r[1] == 2]
    # x: 256, 256, 768, -256 in the first dimension; the second is constant
    assert {r[2] for r in got} == {3} and sorted(r[3] for r in first) == sorted((3 * x - 768) ** 2 for x in (256, 256, 768, -256))
    assert {r[5] for r in first} == {1.0} and all(r[4] is None and r[5] == 0.0 for r in second)
    assert max(r[6] for r in got) < 1e-9


def test_whitening_of_one_distinct_vector_and_of_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<double>")
    got = whiten(df).collect()
    assert len(got) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in got)
    assert whiten(df.limit(0)).count() == 0
    assert whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e10, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whiten(df).collect()} == {None}
