"""Operator 3: toxicity by boosted trees over dense text features, calibrated by isotonic regression.

Labelled documents are split by a hash of their id into three parts: one learns
the lexicon (words, and beginnings of words, that mark toxic texts), one grows the trees, one
calibrates them. All three together are a bounded sample (SAMPLE_ROWS, in
expectation); the features of the whole table are computed in one pass over the
scan with the lexicon held by every task, and the trees run in the JVM.

Features are taken from whole texts only; ids, languages, sources and labels are not
among them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

# Labelled documents used for training, in expectation.
SAMPLE_ROWS = 24_000
# Entries of the learned lexicon.
LEXICON_SIZE = 400
LEAST_TOXIC = 5
LEAST_RATIO = 6.0
THRESHOLD = 0.3
TREES, DEPTH = 20, 4
PREFIXES = (4, 5, 6)

# Common insults of the four languages, as a base for corpora with few labels.
INSULTS = frozenset(
    "idiot moron stupid dumb loser trash scum clown pathetic worthless disgusting fool jerk creep freak imbecile retard bastard "
    "idioten dummkopf trottel abschaum arschloch blödmann versager widerlich "
    "imbécile crétin abruti connard salaud ordure minable débile "
    "idiota imbécil estúpido estúpida tonto basura escoria payaso patético asqueroso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros vuestro".split()
)
# Characters written in place of letters.
LOOKALIKE = str.maketrans("013457@$!|+", "oieastasiit")
EDGE = ".,;:!?\"'()[]{}<>*#%&$-_/\\|~^`=+…«»¿¡“”„’‘"
RUN = re.compile(r"([^\W\d_])\1\1", re.I)
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHOUT = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ]{2,}(?!\w)")
NEAR = 3

FEATURES = (
    "hits", "density", "distinct_hits", "near_second", "window_hits", "base_hits", "base_density", "second_density",
    "capitals", "shouted", "exclaims", "questions", "punctuation", "symbols", "disguised", "runs", "length", "word_length",
)


def words_of(text: str) -> tuple[list[str], int]:
    """Lower-cased words without edge punctuation, with look-alike characters inside words undone, and how many had any."""
    out, disguised = [], 0
    for w in text.lower().split():
        w = w.strip(EDGE)
        if not w:
            continue
        if not w.isalpha() and any(c.isalpha() for c in w):
            plain = w.translate(LOOKALIKE)
            if plain.isalpha() and plain != w:
                disguised += 1
                w = plain
            else:
                bare = "".join(c for c in w if c.isalpha())
                if len(bare) + 1 < len(w) and len(bare) > 2:
                    disguised += 1
                    w = bare
        out.append(w)
    return out, disguised


def tokens_of(words: list[str]) -> set[str]:
    """Lexicon candidates of a text: its words, and word beginnings marked by a trailing dash."""
    found = set(words)
    for n in PREFIXES:
        found.update(w[:n] + "-" for w in words if len(w) > n)
    return found


def split_lexicon(lexicon: frozenset[str]) -> tuple[frozenset[str], ...]:
    """Whole words, then beginnings of each length of PREFIXES."""
    return frozenset(x for x in lexicon if x[-1] != "-"), *(frozenset(x[:-1] for x in lexicon if x[-1] == "-" and len(x) == k + 1) for k in PREFIXES)


def features(text: str | None, lexicon: tuple[frozenset[str], ...]) -> list[float]:
    """Values of FEATURES for a whole text (all zero for a null or empty one)."""
    t = text or ""
    words, disguised = words_of(t)
    n = max(1, len(words))
    whole, four, five, six = lexicon
    at = [i for i, w in enumerate(words) if w in whole or w[:4] in four or w[:5] in five or w[:6] in six]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if at and second:
        s = np.array(second)
        j = np.searchsorted(s, at)
        gap = np.minimum(np.abs(s[np.minimum(j, len(s) - 1)] - at), np.abs(s[np.maximum(j - 1, 0)] - at))
        near = int((gap <= NEAR).sum())
    window = 0
    if at:
        a = np.array(at)
        window = int((np.searchsorted(a, a + 50) - np.arange(len(a))).max())
    base = sum(w in INSULTS for w in words)
    chars = max(1, len(t))
    letters = max(1, sum(map(len, words)))
    marks = sum(map(t.count, ".,;:!?"))
    return [
        np.log1p(len(at)), 100 * len(at) / n, np.log1p(len({words[i] for i in at})), np.log1p(near), np.log1p(window),
        np.log1p(base), 100 * base / n, 100 * len(second) / n,
        len(UPPER.findall(t)) / letters, len(SHOUT.findall(t)) / n,
        100 * t.count("!") / chars, 100 * t.count("?") / chars, 100 * marks / chars,
        100 * sum(map(t.count, "#*$%&|<>")) / chars, disguised / n, len(RUN.findall(t)) / n, np.log1p(len(words)), letters / n,
    ]


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        seen = {0: Counter(), 1: Counter()}
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen[int(toxic)].update(tokens_of(words_of(text or "")[0]))
        keys = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())],
            names=["token", "toxic", "clean"])


def learn_lexicon(train: DataFrame, size: int = LEXICON_SIZE) -> frozenset[str]:
    """Tokens of the (text, toxic) rows that are at least LEAST_RATIO times as frequent in toxic documents."""
    row = train.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    t, c = max(1, row["t"]), max(1, row["c"])
    counts = train.select("text", "toxic").mapInArrow(_token_counts, "token string, toxic long, clean long")
    counts = counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TOXIC)
    ratio = (F.col("toxic") / t) / ((F.col("clean") + 0.5) / c)
    top = counts.where(ratio >= LEAST_RATIO).orderBy(F.desc(F.col("toxic") - F.col("clean") * (t / c)), "token").limit(size)
    return frozenset(r["token"] for r in top.collect())


def with_features(rows: DataFrame, lexicon: frozenset[str], keep: str) -> DataFrame:
    """(keep, one double column per feature) from rows (keep, text); `keep` is one column of any type."""

    parts = split_lexicon(lexicon)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.array([features(t.as_py(), parts) for t in b.column(1)], dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x[:, i]) for i in range(len(FEATURES))]], names=[keep, *FEATURES])

    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "text").mapInArrow(compute, f"{keep} {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def held_out(doc_id: Column) -> Column:
    """Contract fold: crc32 of the id as text leaves 2 modulo 4 (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Labels of held-out documents are never read. `score` is the calibrated
    probability, with a thousandth of the trees' own probability added to order
    documents within a step of the isotonic fit. Edge cases: null and empty texts have zero
    features and are scored like others; null ids take no label; null labels are
    skipped and of several labels of a document the largest counts; with no
    label of one class all scores are the share of toxic labels; repeated rows
    are scored each; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).cast("long").alias("lid")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    n = known.count()
    draw = F.pmod(F.xxhash64("lid", F.lit(3)), F.lit(1_000_000))
    sample = known.where(draw < int(1_000_000 * min(1.0, sample_rows / max(1, n))) + 1) if n > sample_rows else known
    part = F.pmod(F.xxhash64("lid", F.lit(11)), F.lit(10))
    sample = sample.withColumn("part", F.when(part < 4, 0).when(part < 8, 1).otherwise(2))
    # the sample's ids are bounded by sample_rows: the texts need not move to find them
    train = rows.join(F.broadcast(sample), rows["doc_id"] == sample["lid"]).select("text", "toxic", "part", F.xxhash64("lid").alias("key"))
    train = stored(train, "toxicity-sample")
    both = {(r["part"], r["toxic"]): r["n"] for r in train.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = rows.select(F.struct("doc_id").alias("key"), "text")
    if any(both.get((p, c), 0) == 0 for p in (1, 2) for c in (0, 1)):
        share = sum(v for (_, c), v in both.items() if c) / max(1, sum(both.values()))
        return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(float(share)).alias("score"),
                           F.lit(int(share >= THRESHOLD)).alias("predicted"))
    lexicon = learn_lexicon(train.where("part = 0"))
    fit = train.where("part > 0").select(F.struct("toxic", "part").alias("key"), "text")
    fit = stored(with_features(fit, lexicon, "key").select("key.toxic", "key.part", *FEATURES), "toxicity-features")
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    grown = GBTClassifier(labelCol="toxic", maxDepth=DEPTH, maxIter=TREES, stepSize=0.2, subsamplingRate=0.9, seed=7).fit(vector.transform(fit.where("part = 1")))

    def probability(x: DataFrame) -> DataFrame:
        return grown.transform(vector.transform(x)).withColumn("p", vector_to_array("probability")[1])

    calibrate = probability(fit.where("part = 2")).select("p", F.col("toxic").cast("double").alias("toxic"))
    steps = IsotonicRegression(featuresCol="p", labelCol="toxic", predictionCol="step").fit(calibrate)
    scored = probability(with_features(out, lexicon, "key")).select("key.doc_id", "p")
    scored = steps.transform(scored)
    score = F.least(F.greatest(0.999 * F.col("step") + 0.001 * F.col("p"), F.lit(0.0)), F.lit(1.0))
    scored = scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
