"""Training-corpus pipeline: each stage works on all that the one before it kept.

Stages but the last return the columns of ``documents``; a decision takes effect in
the rows or texts that go on. A row without doc_id goes through every stage; an empty
table gives an empty result; further columns are carried along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, grade, pii, simhash
from tidemark.llm.common import read, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal quality classifier does not reject."""
    ratings = grade.ratings_from_labels(read(spark, sf_dir, "labels"))
    return grade.keep_graded(docs, ratings)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that with the smallest id."""
    return simhash.keep_representatives(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars to match."""
    return pii.redact_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and digests of the ids and of the decoded bytes."""
    return bpe.digests(bpe.round_trip(docs))


STAGES = [
    ("quality_classifier", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("personal_data", redact),
    ("byte_bpe", tokenise),
]

# The stages train models and encode by a vocabulary file, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
