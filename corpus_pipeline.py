"""Training corpus from documents: language, exact copies, near copies, personal data, packed sequences.

Each stage reads what the one before has kept, as a table of the columns of ``documents``; the last returns the places of
token pieces in sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from locuswise.llm.exact_dedup import drop_copies
from locuswise.llm.langid import keep_known
from locuswise.llm.packing import packed_documents
from locuswise.llm.pii import pseudonymised
from locuswise.llm.queries import BYTE_BPE, PII_KEY
from locuswise.llm.shingle_join import drop_near_copies
from locuswise.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, predicted with more than even odds. Null, empty and letterless texts go."""
    return keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that agree but for white space: the longest, then the smallest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word-shingle links: the smallest id."""
    return drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in the text. ``n_chars`` stays the length of the original."""
    return pseudonymised(docs, PII_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed_documents(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("personal_data", personal_data), ("packing", packing)]

#: Naive Bayes, a keyed permutation and a packing search have no SQL form; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{k}-{name}")
            docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
