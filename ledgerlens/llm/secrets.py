"""Operator 2: secret scan whose false positives a random forest removes.

Candidates are runs of token characters with a digit among them, and whatever
is assigned to a secret's name (from NAMED_LENGTH characters, of any kind), found
with DataFrame functions in every whole text. Each has features of its length, its
character transitions, how much of it dictionary words cover, the path it was
found under and the words beside it. A random forest, trained on labelled
findings, tells secrets from identifiers, numbers and the like.

No Python runs on the executors: texts are split, filtered and measured by
built-in functions, the dictionary is a word count of all documents (joined
with the candidates' parts only) and the forest is Spark's own.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, stored

LEAST_LENGTH = 12
# Labelled findings the forest is fitted on, in expectation.
TRAIN_ROWS = 50_000
TREES, DEPTH = 20, 6
# A letter run of a candidate is a dictionary word if this many documents' words equal it.
DICTIONARY_COUNT = 20
DICTIONARY_WORD = "^[a-z]{3,20}$"
THRESHOLD = 0.5

CANDIDATE = f"(?=[A-Za-z0-9_+/.=-]*[0-9])[A-Za-z0-9_+/.=-]{{{LEAST_LENGTH},}}"
# Words before a value that name it as a secret.
NAMES = "(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|auth|bearer|credential|private_?key|access_?key)"
# Least characters of a value assigned to such a name; it ends at white space, a quote or the next name=value.
NAMED_LENGTH = 4
_NAME = NAMES + "(?:[_-]?(?:key|value|string|code|hash|id|s))?[0-9_]*[\"'`]?"
_VALUE = f"[\"'`]*([^\\s\"'`]{{{NAMED_LENGTH},}}?)(?=[&;,][A-Za-z_][A-Za-z0-9_]*=|[\\s\"'`]|$)"
NAMED_TEXT = _NAME + "[\\x20\\x09-\\x0D]*[:=]"
NAMED_VALUE = _NAME + "[:=]+>?" + _VALUE
# The words before a value, with one space after each.
NAME_ASSIGNED, NAME_ALONE = _NAME + " ?[:=]+>? $", _NAME + " $"
PLACEHOLDER = "(?i)(example|sample|dummy|placeholder|changeme|your|xxxx|test|fake|0{8}|1234567)"
TEST_PATH = "(?i)(test|spec|example|sample|fixture|doc|mock)"
# Formats that providers publish for their keys.
KNOWN_FORMAT = "^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$|^AIza[0-9A-Za-z_-]{35}$"
NUMBER_LIKE = "^[0-9][0-9.,:/+-]*$"

FEATURES = (
    "length", "transitions", "digits", "upper", "lower", "marks", "distinct", "hex", "vowel_pairs", "dictionary", "known",
    "number", "named", "assigned", "named_near", "placeholder", "placeholder_near", "path_depth", "path_test",
)


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that remain when the pattern's are taken out, from 1."""
    return F.lit(1.0) - F.length(F.regexp_replace(value, pattern, "")).cast("double") / F.length(value)


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """(doc_id, path, word, place, value, name, before, after): every candidate with the words beside it.

    `word` is the index of the white-space word that holds it, `place` the
    number of the candidate in that word (values assigned to a name come after
    the others); `name` is what stands before the value in the same word, with
    the two words before it if they name the value.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    d = d.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED_TEXT)).withColumn("words", F.split("text", SPACE_CLASS)).drop("text")
    word = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    lead = lambda i: F.concat(word(i - 2), F.lit(" "), word(i - 1), F.lit(" "))
    sign = lambda w: F.contains(w, F.lit("=")) | F.contains(w, F.lit(":"))

    def holds(i: Column) -> Column:
        token = (F.length(word(i)) >= LEAST_LENGTH) & word(i).rlike(CANDIDATE)
        return token | sign(word(i)) & (word(i).rlike(NAMED_VALUE) | lead(i).rlike(NAME_ALONE)) | sign(word(i - 1)) & lead(i).rlike(NAME_ASSIGNED)

    d = d.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("words") - 1), holds))
    near = lambda i: F.concat_ws(" ", *[F.coalesce(F.get("words", i + k), F.lit("")) for k in (-3, -2, -1)])
    hit = F.transform("at", lambda i: F.struct(i.alias("word"), F.get("words", i).alias("raw"), lead(i).alias("lead"), near(i).alias("before"), F.coalesce(F.get("words", i + 1), F.lit("")).alias("after")))
    d = d.select("doc_id", "path", F.explode_outer(hit).alias("h")).select("doc_id", "path", "h.*")
    parts = F.regexp_extract_all("raw", F.lit("[A-Za-z0-9_+/.-]+=*"), F.lit(0))
    # a value assigned to a name in this word, or to one in the words before it
    assigned = F.when(F.col("lead").rlike(NAME_ASSIGNED), F.regexp_extract("raw", "^" + _VALUE, 1))
    assigned = assigned.when(F.col("lead").rlike(NAME_ALONE), F.regexp_extract("raw", "^[:=]+>?" + _VALUE, 1)).otherwise("")
    named = F.concat(F.regexp_extract_all("raw", F.lit(NAMED_VALUE), F.lit(3)), F.array(assigned))
    named = F.transform(named, lambda v: F.regexp_replace(v, "[.,;:)\\]}]+$", ""))
    named = F.array_distinct(F.filter(named, lambda v: F.length(v) >= NAMED_LENGTH))
    d = d.withColumns({"parts": parts, "named": named})

    def trimmed(v: Column) -> Column:
        return F.regexp_replace(v, "^[.=-]+|[.]+$", "")

    def split(v: Column) -> Column:
        return F.regexp_extract(v, "^([A-Za-z_]+)=(.+)$", 2)

    def token_value(v: Column) -> Column:
        return F.when(F.length(split(v)) > 0, split(v)).otherwise(F.regexp_replace(v, "=+$", ""))

    able = lambda v: (F.length(v) >= LEAST_LENGTH) & v.rlike("[0-9]")
    tokens = F.filter(F.transform("parts", lambda v: token_value(trimmed(v))), able)
    bare = lambda v: F.regexp_replace(v, "=+$", "")
    other = F.filter("named", lambda v: ~F.exists("tokens", lambda t: bare(t) == bare(v)))
    d = d.withColumn("tokens", tokens).withColumn("named", other)
    numbered = F.concat(
        F.transform("parts", lambda v, i: F.struct(i.cast("int").alias("place"), v.alias("value"), F.lit(False).alias("by_name"))),
        F.transform("named", lambda v, i: F.struct((F.size("parts") + i).cast("int").alias("place"), v.alias("value"), F.lit(True).alias("by_name"))))
    d = d.select("doc_id", "path", "word", "before", "after", "lead", "raw", F.explode_outer(numbered).alias("c"))
    d = d.select("doc_id", "path", "word", "before", "after", "lead", "raw", "c.*")
    d = d.withColumn("value", F.when(F.col("by_name"), F.col("value")).otherwise(trimmed(F.col("value"))))
    d = d.where(F.col("by_name") | able(F.col("value")))
    # "name=value" in one word: the name part goes to `name`
    name = F.expr("substring_index(raw, value, 1)")
    beside = F.when(F.col("by_name") & F.col("lead").rlike(f"{NAME_ASSIGNED}|{NAME_ALONE}"), F.concat("lead", name)).otherwise(name)
    d = d.withColumn("name", F.when(F.col("by_name"), beside).otherwise(F.concat(name, F.regexp_extract("value", "^([A-Za-z_]+=).+$", 1))))
    d = d.withColumn("value", F.when(F.col("by_name"), F.col("value")).otherwise(token_value(F.col("value"))))
    return d.where(F.col("by_name") | able(F.col("value"))).drop("raw", "lead", "by_name")


def with_features(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """`found` with one double column per feature; the dictionary is counted over all documents."""
    found = found.withColumn("uid", F.monotonically_increasing_id())
    found = stored(found, "secret-candidates")
    parts = found.select("uid", F.length("value").alias("len"), F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("part"))
    asked = parts.select("part").distinct()
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z]+")).alias("part")).where(F.length("part").between(3, 20))
    known = words.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= DICTIONARY_COUNT).select("part").join(asked, "part", "left_semi")
    covered = parts.join(known, "part").groupBy("uid").agg(F.sum(F.length("part") / F.col("len")).alias("dictionary"))
    v = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]+", "l"), "[A-Z]+", "u"), "[0-9]+", "d"), "[^lud]+", "m")
    distinct = F.size(F.array_distinct(F.split(v, "")))
    num = lambda c: c.cast("double")
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    f = {
        "length": num(F.length(v)), "transitions": num(F.length(kinds)) / F.length(v),
        "digits": _share(v, "[0-9]"), "upper": _share(v, "[A-Z]"), "lower": _share(v, "[a-z]"), "marks": _share(v, "[^A-Za-z0-9]"),
        "distinct": num(distinct) / F.length(v), "hex": yes(v.rlike("^[0-9a-f]+$")),
        "vowel_pairs": num(F.length(v) - F.length(F.regexp_replace(v, "(?i)[aeiou][bcdfghjklmnpqrstvwxyz]", "x"))) / F.length(v),
        "dictionary": F.coalesce("dictionary", F.lit(0.0)), "known": yes(v.rlike(KNOWN_FORMAT)), "number": yes(v.rlike(NUMBER_LIKE)),
        "named": yes(F.col("name").rlike(NAMES)), "assigned": yes(F.col("name").rlike("[=:]") | F.col("before").rlike("[=:]$")),
        "named_near": yes(F.col("before").rlike(NAMES)), "placeholder": yes(v.rlike(PLACEHOLDER)),
        "placeholder_near": yes(F.concat_ws(" ", "before", "after").rlike(PLACEHOLDER)),
        "path_depth": num(F.length("path") - F.length(F.translate("path", "/", ""))), "path_test": yes(F.col("path").rlike(TEST_PATH)),
    }
    out = found.join(covered, "uid", "left")
    return out.select("uid", "doc_id", "path", "word", "place", "value", "name", "before", "after", *[c.alias(k) for k, c in f.items()])


def rule_labels(x: DataFrame) -> DataFrame:
    """Labelled findings by strict rules, for corpora without reviewed ones: column `label`, other rows dropped.

    1: a provider's format, or a value assigned to a secret's name, that is no
    placeholder; 0: numbers, addresses and placeholders, and values without any such
    word beside them that dictionary words cover by half, and assigned dictionary words. Of
    short values, those without digits and those with other marks only letters with digits are sure.
    """
    open_ = (F.col("length") < LEAST_LENGTH) | (F.col("digits") == 0) | F.col("value").rlike("[^A-Za-z0-9_+/.=-]")
    sure = ~open_ | F.col("value").rlike("^(?=.*[A-Za-z])(?=.*[0-9])[^$<{%(\\[]")
    secret = (F.col("known") > 0) | ((F.col("assigned") > 0) & ((F.col("named") > 0) | (F.col("named_near") > 0)) & (F.col("placeholder") == 0))
    other = (F.col("number") > 0) & (F.col("named") + F.col("named_near") == 0) | (F.col("placeholder") > 0) & (F.col("known") == 0)
    secret = secret & sure
    other = other | (F.col("dictionary") >= 0.95) & (F.col("digits") == 0)
    other = other | (F.col("dictionary") >= 0.5) & (F.col("named") + F.col("named_near") == 0)
    return x.withColumn("label", F.when(secret, 1.0).when(other, 0.0)).where("label is not null")


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
    train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, word, place, value, score, is_secret) of every candidate.

    `labelled` holds reviewed findings (doc_id, value, label 0 / 1); without it
    strict rules label the findings they are sure of. The forest is fitted on a bounded sample
    of these, chosen by hash. Edge cases: null and empty texts hold no
    candidate; a null path is empty; null ids pass through; repeated rows are
    reported each; without labels of both classes the score is their share (0
    without any); an empty table gives no rows; other columns are not read.
    """
    x = stored(with_features(candidates(docs, id_col, text_col, path_col), docs, text_col), "secret-features")
    if labelled is None:
        known = rule_labels(x)
    else:
        known = x.join(labelled.select("doc_id", "value", F.col("label").cast("double").alias("label")).dropDuplicates(["doc_id", "value"]), ["doc_id", "value"])
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    if len([k for k, v in n.items() if v]) < 2:
        score = F.lit(float(n.get(1.0, 0)) / max(1, total))
        out = x.withColumn("score", score)
    else:
        draw = F.pmod(F.xxhash64("value", "doc_id", "word"), F.lit(1_000_000))
        sample = known.where(draw < int(1_000_000 * min(1.0, train_rows / total))) if total > train_rows else known
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=5).fit(vector.transform(sample))
        out = forest.transform(vector.transform(x)).withColumn("score", vector_to_array("probability")[1])
    return out.select("doc_id", "word", "place", "value", "score", (F.col("score") >= threshold).alias("is_secret"))
