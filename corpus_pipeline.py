"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns
of `documents` (the last one adds `copy`); run() writes each stage's result to
the session's shared folder and rereads it as the next one's input.

Edge cases: null ids, sources and other columns are allowed and kept; extra
columns pass through, whatever their names; an empty table gives an empty one
at every stage; very long texts are read whole. What each stage makes of null
or empty texts and of repeated rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, table
from ledgerlens.llm.decontaminate import clean_documents
from ledgerlens.llm.jaccard_join import one_of_each_group
from ledgerlens.llm.line_chunks import without_repeats
from ledgerlens.llm.line_rules import clean_lines
from ledgerlens.llm.mixing import mixed_documents


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars of the current text (null for a null text)."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: rejected documents go, boilerplate lines of a host go from the others.

    Null and empty texts have no words and go; rows alike in id, text and source are kept or rejected alike.
    """
    return _measured(clean_lines(docs)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: repeated line chunks go; so do documents that consisted of nothing else.

    Null and empty texts stay as they are; rows alike in id and text keep or lose the same lines.
    """
    return _measured(without_repeats(docs, drop_emptied=True)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near duplicates the document with the smallest id stays.

    Documents without words stay, each; of rows alike in id and text one does.
    """
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a copy of a benchmark item go.

    Null and empty texts hold nothing and stay; repeated rows go or stay alike.
    """
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one row for each time the mix takes a document, numbered by `copy`.

    Null and empty texts have size 0 and add no words; repeated rows are taken each; ties of the draw go by id, then size.
    """
    return mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# Shingle components and local alignments have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
