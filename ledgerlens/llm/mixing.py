"""Operator 1: mix sources to target weights by weighted sampling without replacement.

Efraimidis-Spirakis sampling: every document draws the exponential key
-ln(u) / w (u from a hash of its id, w its quality weight); the documents of a
source in key order are a weighted random permutation, and a prefix of it whose
sizes add up to the budget is the sample. A target above the size of a source
first takes every document once per complete epoch; only the rest is sampled.

All steps are DataFrame expressions. A source is never sorted in one task: its
documents fall into buckets by ranges of the key (between quantiles of the source's own keys, as weights bend
their distribution; the number of buckets is in proportion to the source), bucket totals are prefix-summed, and only the documents of one bucket
are sorted together. The tables gathered in one task hold one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

# Documents of a source that are sorted together.
BUCKET_ROWS = 20_000
# Quantiles of a large source's keys; the ranges between them are split evenly into as many buckets as its size asks for.
QUANTILES = 128
SYMBOLS = "#*$%&|<>"
KEY_BITS = 52


def quality_weight(text: Column) -> Column:
    """Weight in (0, 1]: 1 / (1 + 20 * share of symbol characters); an empty or null text weighs 1."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    symbols = n - F.length(F.translate(t, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * symbols.cast("double") / F.greatest(n, F.lit(1)).cast("double"))


def uniform(row_id: Column, text: Column, seed: str) -> Column:
    """Uniform in (0, 1) from a hash of the id (of the text, where the id is null)."""
    h = F.md5(F.concat(F.coalesce(row_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))), F.lit(":" + seed)))
    v = F.conv(F.substring(h, 1, KEY_BITS // 4), 16, 10).cast("long")
    return (v.cast("double") + F.lit(0.5)) / F.lit(float(2**KEY_BITS))


def with_buckets(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` (has, src, key, ...) joined to `plan` (has, src, buckets, ...), with `bucket`: it never falls as the key rises."""
    probs = [i / QUANTILES for i in range(1, QUANTILES)]
    large = rows.join(plan.where("buckets > 1").select("has", "src"), ["has", "src"])
    bounds = large.groupBy("has", "src").agg(
        F.percentile_approx("key", probs, 40 * QUANTILES).alias("q"), F.min("key").alias("least"), F.max("key").alias("most"))
    r = rows.join(plan, ["has", "src"]).join(bounds, ["has", "src"], "left")
    at = F.when(F.col("q").isNull(), F.lit(0)).otherwise(F.size(F.filter("q", lambda x: x <= F.col("key"))))
    r = r.withColumn("range", at).withColumn("parts", F.ceil(F.col("buckets") / F.lit(float(QUANTILES))))
    lo = F.coalesce(F.get("q", F.col("range") - 1), F.col("least"))
    hi = F.coalesce(F.get("q", F.col("range")), F.col("most"))
    part = F.when(hi > lo, F.least(F.floor((F.col("key") - lo) / (hi - lo) * F.col("parts")), F.col("parts") - 1)).otherwise(0)
    return r.withColumn("bucket", (F.col("range") * F.col("parts") + part).cast("long")).drop("q", "least", "most", "range", "parts")


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: tuple[int, int], cap: int) -> DataFrame:
    """Targets of a (has, src, source_size, n_docs) table: one row per source.

    Sources by code point (null last) take `weights` in turn and share
    budget = size * budget[0] / budget[1]. A target stops at `cap` times its
    source; the excess is shared by weight among the rest until none is above.
    That fixed point is target = min(cap * size, level * weight) with one level
    for all, found from prefix sums in the order of cap * size / weight.
    """
    k = len(weights)
    by_name = Window.orderBy(F.col("has").desc(), "src")
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % k + 1).cast("int")).cast("long"))
    s = s.withColumn("full", F.col("source_size") * cap).withColumn("ratio", F.col("full").cast("double") / F.col("w"))
    order = Window.orderBy("ratio", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(whole).cast("double") * budget[0] / budget[1])
    s = s.withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0)).cast("double")) / F.sum("w").over(rest).cast("double")
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))
    s = s.withColumn("level", F.min(fits).over(whole)["level"])
    return s.select(
        "has", "src", "source_size", "n_docs",
        F.least(F.col("full").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("full").cast("double"))).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    budget: tuple[int, int] = (3, 2),
    cap: int = 2,
    seed: str = "mix-1",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Words taken from every document: (doc_id, source, size, source_size, target, weight, copies, taken).

    `copies` is how often the mix repeats the document, `taken` = copies * size.
    The fractional part takes a document when at least half of it lies below
    the remaining budget, so a source misses its target by at most half a
    document. Reruns agree: keys depend on ids (where null, on texts) alone.

    Edge cases: a null text has size 0 and weight 1; a null source is a source
    of its own, last in order; documents without id draw by their text;
    repeated rows are kept and counted each (rows alike in id and size are
    interchangeable); documents of size 0 add no words and no document has more than
    `cap` copies; a source of size 0 is not taken; an empty table gives no
    rows. Other columns of `docs` are not read.
    """
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        quality_weight(F.col(text_col)).alias("weight"),
        uniform(F.col(id_col), F.col(text_col).cast("string"), seed).alias("draw"),
    ).withColumns({
        "key": -F.log(F.col("draw")) / F.col("weight"),
        "has": F.col("source").isNotNull(),
        "src": F.coalesce("source", F.lit("")),
    })
    # sizes are the only work on texts; everything below rereads these few bytes per document
    slim = stored(slim, "mix-sizes")
    sizes = slim.groupBy("has", "src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    plan = source_targets(sizes, weights, budget, cap)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("left", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double"))
    plan = plan.withColumn("buckets", F.ceil(F.col("n_docs") / F.lit(float(bucket_rows))))

    rows = with_buckets(slim.drop("draw"), plan)
    totals = rows.groupBy("has", "src", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("has", "src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("has", "src", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("has", "src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(starts, ["has", "src", "bucket"]).withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    extra = ((F.col("left") > 0) & ((2 * F.col("before") + F.col("size")).cast("double") <= 2 * F.col("left"))).cast("long")
    rows = rows.withColumn("copies", F.least(F.col("epochs") + extra, F.lit(cap)))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "weight", F.col("copies").cast("long").alias("copies"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of `docs` with column `copy` (1, 2, ...), one row for each time the mix takes them.

    Columns of `docs` are kept as they are; `doc_id` should be unique (rows
    that share an id get the copies of one of them each).
    """
    id_col = options.get("id_col", "doc_id")
    taken = mix_sources(docs, **options).where("copies > 0").groupBy(F.col("doc_id").alias("__mix_id")).agg(F.max("copies").alias("__mix_n"))
    out = docs.join(taken, docs[id_col].eqNullSafe(taken["__mix_id"]))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_n")))).drop("__mix_id", "__mix_n")
