"""From raw documents to packed sequences: each stage is one of the operators in cardledger.llm.

run(spark, sf_dir) applies STAGES in turn to the documents. Each stage's result is written to the
shared folder and read again as the next one's documents. The stages rest on trained models, on word
edit distances and on graph components, which SQL cannot express; tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardledger.llm import decontamination, line_dedup, ngram_jaccard_join, packing, quality_rules
from cardledger.llm.queries import table, vocabulary
from cardledger.sources.scratch import saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trained quality and toxicity models."""
    labels = table(spark, sf_dir, "labels")
    return quality_rules.keep(docs, quality_rules.learn(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur earlier; those of which nothing is left go."""
    return line_dedup.drop_emptied(line_dedup.dedup_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return ngram_jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their place in the sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
