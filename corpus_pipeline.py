"""From raw documents to a packing plan: five stages, each reading what the one before it has written.

A stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosopon.llm import ngram_join, packing, pii, quality, toxicity
from prosopon.llm.common import read_table
from prosopon.operators.durable import write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much text or fail the base rule."""
    return quality.keep_good(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the classifier learns from the labelled rows that are left."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link (five words, Jaccard 0.8) the one with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redacted(docs)


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every document, by its exact number of tokens."""
    import public_tokenizers

    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxic), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", length_buckets)]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
