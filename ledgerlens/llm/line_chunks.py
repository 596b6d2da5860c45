"""Operator 10: removal of repeated runs of lines by content-defined chunks.

A chunk begins at a line and takes the fewest lines that have CHUNK characters
together; a long line is a chunk of its own. Every line begins a chunk, so a
chunk depends on nothing but its own lines and a passage has the same chunks wherever
it stands. A hash is taken of each chunk (a window of lines that rolls
over the document); where hashes begin and cease to occur elsewhere are the
boundaries of a repeated passage. Chunks that occur again anywhere in the
corpus are removed, but for the first occurrence (by doc_id, then text hash,
then position), once their bytes have been compared; overlapping chunks remove a passage from its first line on, to less than CHUNK characters before its end.

Boundaries chosen by a residue of the rolling hash, with chunks between them,
were built first: between different surroundings they left 39 % of the repeated
passages of 10 lines and 84 % of those of 5 whole, as no chunk lay between two such boundaries.

DataFrame functions only. Repeats are found on hashes and places alone. Bodies
are cut in a second scan, held against a key filter of the repeated hashes (of bounded
size) before they move, and compared by a join on the hash, one row per hash on one side,
so a chunk in a third of all documents can be split. Only texts that lose lines are
shuffled, to the lists of their chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import split_by_keys, stored

# Characters (line ends within included) from which a run of lines is a chunk.
CHUNK = 120


def _held(column: Column) -> Column:
    """A generator of one row: its output is computed once, however often it is used."""
    return F.explode(F.array(column))


def with_chunks(slim: DataFrame, chars: int, bodies: bool) -> DataFrame:
    """(doc_id, th, pos, n, h[, body]) of every chunk of (doc_id, th, text): first line, number of lines, hash.

    The last lines of a text begin no chunk if they have fewer than `chars` characters together.
    """
    d = slim.select("doc_id", "th", _held(F.split("text", "\n", -1)).alias("lines")).where("lines is not null")

    def size(i: Column) -> Column:
        """(characters, lines) of the shortest run from line i on; every line adds one character at least."""
        start = F.struct(F.lit(-1).alias("chars"), F.lit(0).alias("n"))
        more = lambda a, x: F.when(a["chars"] >= chars, a).otherwise(F.struct((a["chars"] + 1 + F.length(x)).alias("chars"), (a["n"] + 1).alias("n")))
        return F.aggregate(F.slice("lines", i + 1, chars + 1), start, more)

    def chunk(i: Column) -> Column:
        line = F.get("lines", i)
        run = F.when(F.length(line) >= chars, F.struct(F.length(line).alias("chars"), F.lit(1).alias("n"))).otherwise(size(i))
        return F.struct(i.alias("pos"), run.alias("run"))

    runs = F.filter(F.transform(F.sequence(F.lit(0), F.size("lines") - 1), chunk), lambda c: c["run"]["chars"] >= chars)
    d = d.select("doc_id", "th", "lines", _held(runs).alias("runs"))
    body = lambda c: F.when(c["run"]["n"] == 1, F.get("lines", c["pos"])).otherwise(F.array_join(F.slice("lines", c["pos"] + 1, c["run"]["n"]), "\n"))
    given = F.transform("runs", lambda c: F.struct(c["pos"].alias("pos"), c["run"]["n"].alias("n"), (body(c) if bodies else F.xxhash64(body(c))).alias("x")))
    # outer: a plain explode would add a filter that cuts the chunks a second time, below it
    d = d.select("doc_id", "th", F.explode_outer(given).alias("c")).where("c is not null").select("doc_id", "th", "c.pos", "c.n", "c.x")
    return d.withColumn("h", F.xxhash64("x")).withColumnRenamed("x", "body") if bodies else d.withColumnRenamed("x", "h")


# null ids come last, as the first occurrence should have an id
_PLACE = ("no_id", "doc_id", "th", "pos")


def removed_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = CHUNK) -> DataFrame:
    """(doc_id, th, gone): the chunks to remove, array of (pos: first line, n: lines) in order, of each document that has any."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "pos")
    found = with_chunks(slim, chars, bodies=False).groupBy("h").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
    first = stored(found.where("times > 1").select("h", "first", F.xxhash64("h", *[F.col("first")[c] for c in _PLACE]).alias("key")), "chunks-first")
    bodies, _ = split_by_keys(with_chunks(slim, chars, bodies=True), F.col("h"), first, "h")
    bodies = stored(bodies.withColumn("place", place), "chunk-bodies")
    # the first occurrences: a second filter, then the exact join; rows alike in id and text are one
    some, _ = split_by_keys(bodies, F.xxhash64("h", *[F.col("place")[c] for c in _PLACE]), first, "key")
    kept = some.select("h", "place", "body").join(first.select("h", F.col("first").alias("place")), ["h", "place"], "left_semi")
    kept = kept.dropDuplicates(["h"]).select("h", F.col("place").alias("first"), F.col("body").alias("first_body"))
    equal = bodies.join(kept.hint("merge"), "h").where((F.col("body") == F.col("first_body")) & ~F.col("place").eqNullSafe(F.col("first")))
    # a set, as rows alike in id and text name the same chunks
    gone = F.sort_array(F.collect_set(F.struct("pos", "n")))
    return stored(equal.groupBy("doc_id", "th").agg(gone.alias("gone")), "chunks-gone")


def _key(doc_id: Column, th: Column) -> Column:
    return F.xxhash64(doc_id, th)


def _lines_in(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def _left_text(lines: Column, gone: Column) -> Column:
    """The lines outside the chunks of `gone`, which are in order and end in order."""
    def between(j: Column) -> Column:
        start = F.when(j == 0, 0).otherwise(F.get(gone, j - 1)["pos"] + F.get(gone, j - 1)["n"])
        stop = F.when(j == F.size(gone), F.size(lines)).otherwise(F.get(gone, j)["pos"])
        return F.slice(lines, start + 1, F.greatest(stop - start, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = CHUNK, drop_emptied: bool = False,
) -> DataFrame:
    """`docs` with repeated chunks removed from its text, and columns __n_lines, __removed_lines.

    `drop_emptied` leaves out documents that lose all their lines. Edge cases: a null text stays null, an empty one empty (one empty line); a
    text that loses all lines becomes empty; rows alike in id and text count as one
    document, which keeps its first chunks in every such row, and rows that
    share an id only are told apart by their texts; a text shorter than a chunk is left alone; an empty table gives no rows;
    other columns pass through.
    """
    gone = removed_chunks(docs, id_col, text_col, chars).withColumn("key", _key(F.col("doc_id"), F.col("th")))
    own = F.xxhash64(text_col)
    some, others = split_by_keys(docs, _key(F.col(id_col), own), gone, "key")
    there = gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("gone").alias("__gone"))
    # merged at every size: a broadcast of this side would end at some number of documents
    d = some.join(there.hint("merge"), F.col(id_col).eqNullSafe(F.col("__id")) & (own == F.col("__th")), "left").drop("__id", "__th")
    n_lines = F.coalesce(_lines_in(F.col(text_col)), F.lit(0)).cast("long")
    none = F.lit(0).cast("long")
    changed = d.where("__gone is not null").select(
        *docs.columns, "__gone", n_lines.alias("__n_lines"), _held(F.split(F.col(text_col), "\n", -1)).alias("__lines"))
    changed = changed.select(*docs.columns, "__n_lines", _held(_left_text(F.col("__lines"), F.col("__gone"))).alias("__left"))
    changed = changed.select(
        *[F.array_join("__left", "\n").alias(c) if c == text_col else F.col(c) for c in docs.columns],
        "__n_lines", (F.col("__n_lines") - F.size("__left")).cast("long").alias("__removed_lines"))
    if drop_emptied:
        changed = changed.where("__removed_lines < __n_lines")
    same = others.unionByName(d.where("__gone is null").select(*docs.columns))
    return changed.unionByName(same.withColumns({"__n_lines": n_lines, "__removed_lines": none}))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, removed_lines, text) of every document; see `without_repeats` for the cases."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = without_repeats(slim, "doc_id", "text", **options)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__removed_lines").alias("removed_lines"), "text")
