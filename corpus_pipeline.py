"""A corpus pipeline over ``documents``: quality rules, line dedup, n-gram
Jaccard join, benchmark decontamination, mixing of sources.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows that the
stage before it kept, and is written as Parquet in the shared folder before the
next one reads it.  All but the last return the columns of ``documents``; the
last returns the words that the mix takes from each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martspark.llm import decontaminate, jaccard, lines, mixing, quality
from martspark.llm.common import table
from martspark.plans.stage import stage

# The query op6_jaccard has a contract of its own (jaccard.OP6); the stage takes the wider net.
NEAR = jaccard.Rule(words=5, num=80, den=100)

# The query op5_lines has a contract of its own (its oracle SQL); on sf0.1 repeated lines stand on 1 to 5 % of a
# source's pages, which only a share of 1 % reaches. The page minimum spares chance repeats on small sources.
LINE_RATIO, LINE_PAGES = 0.01, 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source."""
    return lines.drop_boilerplate(docs, length_col="n_chars", ratio=LINE_RATIO, min_pages=LINE_PAGES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents (5-word shingles, similarity 0.8 or more)."""
    return jaccard.keep_one(docs, rule=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and words taken of every document."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

# The certified cutoffs and the components have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
