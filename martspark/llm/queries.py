"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (conversations, decontaminate, hyperminhash, jaccard, langid, licenses, lines, mixing, quality, secrets,
               spelling, token_counts, toxicity)
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out quarter."""
    return langid.language_report(table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of each of its lines."""
    return token_counts.token_report(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, each distinct text scanned once."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template notices in every document."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of every document's source, and the text without them."""
    return lines.line_report(table(spark, sf_dir, "documents"))


@query
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard.link_components(table(spark, sf_dir, "documents"), rule=jaccard.OP6)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels outside the held-out fifth."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the rebuilt conversations."""
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the corpus with their near words, forms and roots."""
    return spelling.spelling_report(table(spark, sf_dir, "documents"))
