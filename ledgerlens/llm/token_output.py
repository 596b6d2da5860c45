"""Operator 11: token ids of a corpus in a compressed binary format, and their reading.

1. `write_tokens` orders documents by id (range partitions, sorted inside),
   tokenises every whole text, appends the end id and writes blocks of the
   coder of `id_coder`; it returns the index of the files it wrote.
2. `with_starts` numbers the ids of all files: a running sum over the tasks,
   the only figures (one a task) that the driver sees.
3. `read_tokens` decodes the files and returns every document's place, length
   and checksum, with its ids if asked for.

File: MAGIC, size of the vocabulary (u32), blocks. Block: header of seven u32
(ids, lanes, coded 16-bit words, documents, bytes of the document table, bytes
of the lane table, CRC-32 of the six and of the body), document table, lane table,
words. All is little-endian; both tables are zlib streams. The document table
names the documents whose ids the block holds, with the number of ids
here and whether the document goes on in the next block, so a document of any length may span
blocks. The lane table holds the state from which each lane is decoded. Every block decodes without the others.

Files are written through pyarrow's file systems into the session's shared
folder under names of their own for each attempt; the index, committed by
Spark, says which files count. A task that is lost and run again leaves no
document twice.

Edge cases: a null text is empty (one end id); null ids come last; rows that
share an id are documents each, by text hash, then row; a text that spells a
special token of the vocabulary gets that token's id, as the library reads it;
an empty table gives no file and no row; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, stored
from .id_coder import ORDER0_BITS, decode_ids, encode_ids, lane_layout

MAGIC = b"LLTOKID2"
HEADER = struct.Struct("<7I")
END_ID = 0
BLOCK_IDS = 1 << 20
# A new file is begun at the first document's end after this many ids.
FILE_IDS = 8 << 20
# Texts are tokenised in runs of about this many characters.
RUN_CHARS = 4 << 20
# A worker keeps the ids of pieces of so many characters in all, then only those that several runs had.
CACHE_CHARS = 8 << 20

INDEX_SCHEMA = "part int, seq int, file string, n_docs long, n_ids long, n_blocks long, n_bytes long"
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"

_PIECE = re.compile(r"\s*\S+|\s+")
# A space beside other white space: such texts are not split at single spaces.
_WIDE_SPACE = re.compile(r" (?:(?=\s)|(?<=\s ))")
# For Arrow: a space beside any white space that Python knows. It only picks the texts that are looked at.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MAYBE_WIDE = f" {_SPACES}|{_SPACES} "
# White space for Python, but ordinary characters for the tokenizer's word pattern.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_LOADED: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct piece once.

    A byte-level BPE with the usual word pattern never merges across the place
    between a character and white space after it, so a text's ids are those of
    its pieces. Texts are cut at single spaces (by Arrow, which also finds the distinct pieces of a run);
    texts with wider white space by a pattern, and those with control characters on which the
    two ideas of white space differ go to the library whole. New pieces are
    joined to one text for the library; its ids fall to the pieces by their bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        if self.vocabulary >= 1 << (ORDER0_BITS - 1):
            raise ValueError(f"a vocabulary of {self.vocabulary} ids is beyond the coder's order-0 precision")
        special = {k: v.content for k, v in self.library.get_added_tokens_decoder().items()}
        # a character of the byte alphabet stands for each byte of an ordinary id
        names = ((k, self.library.id_to_token(k)) for k in range(self.vocabulary))
        self.n_bytes = np.array([len(special[k].encode()) if k in special else len(name or "") for k, name in names], np.int64)
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.first, self.size, self.pool, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.int32), 0
        self.uses, self.chars = np.zeros(1024, np.int32), 0

    def _trim(self) -> None:
        """Forget the pieces that one run alone has had since the last time; all, if the others take more than half the room."""
        often = np.flatnonzero(self.uses[: len(self.places)] > 1)
        names = list(self.places)
        names, ids, sizes = [names[k] for k in often.tolist()], self._ids_at(often), self.size[often]
        self._clear()
        if sum(map(len, names)) <= CACHE_CHARS // 2:
            self._keep(names, ids, sizes)

    def _ids_at(self, at: np.ndarray) -> np.ndarray:
        """The ids of pieces, one after another."""
        size, first = self.size[at], self.first[at]
        ends = np.cumsum(size)
        places = np.repeat(first - (ends - size), size)
        places += np.arange(len(places))
        return self.pool.take(places)

    def _add(self, pieces: list[str]) -> None:
        """Encode new pieces: those that begin with white space and end without it as one text, the others each alone."""
        # one look at all of them: control characters are rare
        odd = _ODD_SPACE.search("".join(pieces)) is not None
        joined, alone = [], []
        for p in pieces:
            fits = p[:1].isspace() and not p[-1:].isspace() and not (odd and _ODD_SPACE.search(p))
            (joined if fits else alone).append(p)
        if joined:
            ids = np.array(self.library.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(pc.binary_length(pa.array(joined, pa.large_string())).to_numpy())
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
            self._keep(joined, ids, np.diff(cuts, prepend=0))
        if alone:
            got = [e.ids for e in self.library.encode_batch_fast(alone, add_special_tokens=False)]
            self._keep(alone, np.array([i for g in got for i in g], np.int32), np.array([len(g) for g in got], np.int64))

    def _keep(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        k, n = len(self.places), len(pieces)
        if k + n > len(self.first):
            self.first, self.size, self.uses = (np.resize(a, 2 * (k + n)) for a in (self.first, self.size, self.uses))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + len(ids)))
        self.first[k : k + n] = self.used + np.cumsum(sizes) - sizes
        self.size[k : k + n] = sizes
        self.uses[k : k + n] = 0
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.chars += len("".join(pieces))
        self.places.update(zip(pieces, range(k, k + n)))

    def _at(self, pieces: list[str]) -> np.ndarray:
        at = list(map(self.places.get, pieces))
        missing = [k for k, place in enumerate(at) if place is None]
        if missing:
            self._add(list(dict.fromkeys([pieces[k] for k in missing])))
            for k in missing:
                at[k] = self.places[pieces[k]]
        return np.array(at, np.int64)

    def run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, END_ID after each; number of ids of each text with its end id)."""
        if self.chars > CACHE_CHARS:
            self._trim()
        strings = texts.to_pylist()
        looked_at = np.flatnonzero(pc.match_substring_regex(texts, _MAYBE_WIDE).to_numpy(zero_copy_only=False))
        wide = [k for k in looked_at.tolist() if _WIDE_SPACE.search(strings[k])]
        cut = pc.split_pattern(pc.if_else(pa.array(np.isin(np.arange(len(strings)), wide)), "", texts), " ")
        counts = cut.value_lengths().to_numpy()
        starts = np.cumsum(counts) - counts
        coded = cut.flatten().dictionary_encode()
        # through numpy: Arrow makes a scalar of each string of a list
        words = pc.binary_join_element_wise("", coded.dictionary, " ").to_numpy(zero_copy_only=False).tolist()
        distinct = self._at(words)
        self.uses[distinct] += 1
        at = distinct[coded.indices.to_numpy()]
        # a text's first piece has no space before it
        at[starts] = self._at([t.partition(" ")[0] for t in strings])
        if wide:
            split = [[t] if _ODD_SPACE.search(t) else _PIECE.findall(t) for t in (strings[k] for k in wide)]
            own = self._at([p for pieces in split for p in pieces])
            # the pieces of wide texts take the place of their one empty piece
            lengths = np.array([len(x) for x in split])
            keep = np.ones(len(at), bool)
            keep[starts[wide]] = False
            into = np.repeat(starts[wide], lengths)
            at = np.insert(at, into, own)[np.insert(keep, into, True)]
            counts = counts.copy()
            counts[wide] = lengths
        total = np.concatenate([[0], np.cumsum(self.size[at])])
        ends = total[np.cumsum(np.concatenate([[0], counts]))]
        # an end id after each text
        after = np.diff(ends) + 1
        ids = np.full(total[-1] + len(after), END_ID, np.int32)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(after) - 1] = False
        ids[inside] = self._ids_at(at)
        return ids, after


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file (loaded once a process)."""
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


# ---------------------------------------------------------------- blocks


def block_bytes(ids: np.ndarray, docs: list[tuple[int | None, int, bool]], vocabulary: int) -> bytes:
    """One block: its ids, and (doc_id, ids in this block, goes on) of each document in it."""
    words, states = encode_ids(ids, vocabulary)
    table = np.zeros(len(docs), np.dtype([("id", "<i8"), ("n", "<u4"), ("null", "u1"), ("on", "u1")]))
    for k, (doc_id, n, on) in enumerate(docs):
        table[k] = (doc_id or 0, n, doc_id is None, on)
    docs_z = zlib.compress(b"".join(table[c].tobytes() for c in table.dtype.names), 1)
    lanes_z = zlib.compress(states.astype("<u8").tobytes(), 1)
    body = docs_z + lanes_z + words.astype("<u2").tobytes()
    head = (len(ids), len(states), len(words), len(docs), len(docs_z), len(lanes_z))
    return HEADER.pack(*head, zlib.crc32(body, zlib.crc32(struct.pack("<6I", *head)))) + body


def read_block(handle, vocabulary: int) -> tuple[np.ndarray, list[tuple[int | None, int, bool]]] | None:
    """The next block's ids and documents; None at the end of the file. A damaged block raises ValueError."""
    raw = handle.read(HEADER.size)
    if not raw:
        return None
    if len(raw) < HEADER.size:
        raise ValueError("token file ends inside a block header")
    *head, check = HEADER.unpack(raw)
    n, lanes, n_words, n_docs, docs_len, lanes_len = head
    body = handle.read(docs_len + lanes_len + 2 * n_words)
    if zlib.crc32(body, zlib.crc32(raw[:-4])) != check or lanes != lane_layout(n)[0]:
        raise ValueError("token block does not match its checksum")
    docs_raw = zlib.decompress(body[:docs_len])
    cols = [np.frombuffer(docs_raw, t, n_docs, at * n_docs) for t, at in (("<i8", 0), ("<u4", 8), ("u1", 12), ("u1", 13))]
    states = np.frombuffer(zlib.decompress(body[docs_len : docs_len + lanes_len]), "<u8")
    ids = decode_ids(np.frombuffer(body, "<u2", n_words, docs_len + lanes_len), states, n, vocabulary)
    docs = [(None if null else i, k, bool(on)) for i, k, null, on in zip(*(c.tolist() for c in cols))]
    return ids, docs


class _Files:
    """Files of one task: documents come in order, blocks and files are begun as they fill."""

    def __init__(self, folder: str, vocabulary: int, block_ids: int, file_ids: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.vocabulary, self.block_ids, self.file_ids = vocabulary, block_ids, file_ids
        self.part, self.handle, self.index = TaskContext.get().partitionId(), None, []
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, bool]] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        while len(ids) > self.block_ids - self.held:
            cut = self.block_ids - self.held
            self._hold(doc_id, ids[:cut], True)
            ids = ids[cut:]
            self._block()
        self._hold(doc_id, ids, False)
        self.row["n_docs"] += 1
        if self.held == self.block_ids:
            self._block()
        if self.row["n_ids"] >= self.file_ids:
            self.close()

    def _hold(self, doc_id: int | None, ids: np.ndarray, on: bool) -> None:
        if self.handle is None:
            name = f"{uuid.uuid4().hex}.ids"
            self.handle = self.fs.open_output_stream(f"{self.folder}/{name}")
            self.handle.write(MAGIC + struct.pack("<I", self.vocabulary))
            self.row = {"part": self.part, "seq": len(self.index), "file": name, "n_docs": 0, "n_ids": 0, "n_blocks": 0, "n_bytes": 0}
        self.parts.append(ids)
        self.docs.append((doc_id, len(ids), on))
        self.held += len(ids)
        self.row["n_ids"] += len(ids)

    def _block(self) -> None:
        raw = block_bytes(np.concatenate(self.parts), self.docs, self.vocabulary)
        self.handle.write(raw)
        self.row["n_blocks"] += 1
        self.row["n_bytes"] += len(raw)
        self.parts, self.docs, self.held = [], [], 0

    def close(self) -> None:
        if self.handle is None:
            return
        if self.docs:
            self._block()
        self.handle.close()
        self.handle = None
        self.index.append(self.row)


# ---------------------------------------------------------------- Spark


def token_folder(spark: SparkSession, name: str = "tokens") -> str:
    """A new folder in the session's shared folder, as a URI for pyarrow's file systems."""
    path = scratch_path(spark, name)
    path = path if "://" in path else "file://" + path.removeprefix("file:")
    fs, inner = pafs.FileSystem.from_uri(path)
    fs.create_dir(inner, recursive=True)
    return path


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.Array]]:
    """(ids, texts) of a batch in runs of about RUN_CHARS bytes; null texts are empty."""
    ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
    run = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // RUN_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(ids)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield ids[lo:hi], texts.slice(lo, hi - lo)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of every whole text into files of `folder` in ascending id order; returns the committed index (INDEX_SCHEMA).

    `tokenizer` is the path of a byte-level BPE file of the tokenizers library, the same on all workers.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        files = _Files(folder, enc.vocabulary, block_ids, file_ids)
        for b in batches:
            for doc_ids, texts in _runs(b):
                ids, counts = enc.run(texts)
                for doc_id, part in zip(doc_ids, np.split(ids, np.cumsum(counts)[:-1])):
                    files.add(doc_id, part)
        files.close()
        yield pa.RecordBatch.from_pylist(files.index, schema=pa.schema(
            [("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_blocks", pa.int64()), ("n_bytes", pa.int64())]))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumns({"th": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    # the hash and the row split documents that share an id (null ids of many rows) over partitions
    order = [F.col("doc_id").asc_nulls_last(), F.col("th").asc(), F.col("row").asc()]
    ordered = src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(ordered.mapInArrow(write, INDEX_SCHEMA), "token-index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with `start`: number of ids in all files before. One sum per writing task goes to the driver."""
    from pyspark.sql import Window

    spark = index.sparkSession
    sums = sorted((r["part"], r["n"]) for r in index.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, starts = 0, []
    for part, n in sums:
        starts.append((part, before))
        before += n
    tasks = spark.createDataFrame(starts, "part int, base long")
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = index.withColumn("inside", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long")))
    return inside.join(tasks, "part").select(*index.columns, (F.col("base") + F.col("inside")).alias("start"))


def read_tokens(index: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files of an index with starts.

    `with_ids` adds `ids` (array<int>), the document's ids. A block that does not match its checksum raises.
    """
    schema = DOC_SCHEMA + (", ids array<int>" if with_ids else "")
    types = [pa.int64()] * 4 + ([pa.list_(pa.int32())] if with_ids else [])
    names = [c.split()[0] for c in schema.split(", ")]

    def rows_of(handle, start: int) -> Iterator[list[tuple]]:
        if handle.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        vocabulary = struct.unpack("<I", handle.read(4))[0]
        n, crc, held = 0, 0, []
        while (block := read_block(handle, vocabulary)) is not None:
            ids, docs = block
            raw, at, rows = memoryview(ids.astype("<u4").tobytes()), 0, []
            for doc_id, k, on in docs:
                crc = zlib.crc32(raw[4 * at : 4 * (at + k)], crc)
                if with_ids:
                    held.append(ids[at : at + k])
                n, at = n + k, at + k
                if not on:
                    rows.append((doc_id, start, n, crc, *([np.concatenate(held)] if with_ids else [])))
                    start, n, crc, held = start + n, 0, 0, []
            yield rows

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(f"{inner}/{file}") as handle:
                    for rows in rows_of(handle, start):
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    n_files = max(index.count(), 1)
    # one file a task: sampled bounds of as many distinct starts
    files = index.select("file", "start").repartitionByRange(n_files, "start")
    return files.mapInArrow(read, schema)


def token_ids(
    docs: DataFrame, tokenizer: str, with_ids: bool = False, **options
) -> tuple[DataFrame, DataFrame, str]:
    """Write all documents and read them back: (documents as read, index of the files, their folder)."""
    folder = token_folder(docs.sparkSession)
    index = stored(with_starts(write_tokens(docs, folder, tokenizer, **options)), "token-starts")
    return read_tokens(index, folder, with_ids), index, folder
