"""A corpus made ready for training: stages over ``documents``, each on what the one before kept.

Each stage sets the session to small batches for Python, so that an executor can run all of them one after another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogflow.llm.common import small_batches, stored, table
from catalogflow.llm.decontaminate import without_items
from catalogflow.llm.near import one_of_each
from catalogflow.llm.packing import pack_documents
from catalogflow.llm.pii import redact_pii
from catalogflow.llm.toxicity import toxicity_score, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5."""
    small_batches(spark)
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(model, "text") < 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    small_batches(spark)
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    small_batches(spark)
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of personal data."""
    small_batches(spark)
    return redact_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic), ("ngram_jaccard", keep_one_of_each), ("decontamination", drop_contaminated), ("pii", redact), ("packing", pack),
]

#: SQL cannot train the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
