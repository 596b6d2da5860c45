"""Registered queries opN_<name>: each applies its operator, with production settings, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import contaminated
from .html_text import extract_text
from .jaccard_join import jaccard_groups
from .lexical_search import search
from .line_chunks import line_dedup
from .line_rules import line_rules
from .mixing import mix_sources
from .oracles import OP1, OP10, OP12
from .registry import register
from .secrets import scan_secrets
from .token_output import token_ids
from .toxicity import score_toxicity
from .url_filter import judge_urls
from .warc import archive_pages
from .whitening import whiten


@register("op1_source_mix", OP1)
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: words that the mix of all documents takes from each document."""
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@register("op4_line_rules")
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: base rules and line-frequency verdict of every document (host: its source)."""
    return line_rules(table(spark, sf_dir, "documents"))


@register("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: verdict of rules or character models for every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages"))


@register("op5_warc_revisits")
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: archives of all pages with revisit records, read back."""
    return archive_pages(table(spark, sf_dir, "pages"))[0]


@register("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


@register("op7_jaccard_groups")
def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: component of every document under links of Jaccard similarity 0.8 on five-word shingles."""
    return jaccard_groups(table(spark, sf_dir, "documents"))


@register("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: every document and benchmark item it holds an exact or edited copy of."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_line_dedup", OP10)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: text of every document without chunks of lines that occur earlier in the corpus."""
    return line_dedup(table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: calibrated toxicity score of every document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: every secret candidate of all documents, scored by the forest."""
    return scan_secrets(table(spark, sf_dir, "documents"))


@register("op11_token_ids")
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: place, length and checksum of every document's token ids, read back from the coded files."""
    import public_tokenizers

    return token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))[0]


@register("op13_whitened_embeddings")
def op13_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: whitened components of every usable embedding, fitted on the distinct quantised vectors."""
    return whiten(table(spark, sf_dir, "embeddings"))


@register("op12_lexical_search", OP12)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: the ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
