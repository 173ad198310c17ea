"""The training-data pipeline: quality rules, line dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `docs`. `run` writes each stage's result to the cluster's shared folder and reads it
again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesforge.llm import jaccard, lines, mixing, packing, rules
from seriesforge.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    learned = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.kept_only(docs, learned)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of templates that recur across documents."""
    return lines.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.packed(docs, packing.default_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

#: The decision list is learned, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
