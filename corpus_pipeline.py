"""A training corpus from ``documents``: toxic documents out, copies out, near copies out, mixed by source, tokenised.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a frame that is
written before the next one reads it; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelhouse.llm import byte_bpe, exact_dedup, mixing, near_dedup, toxicity
from reelhouse.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from their labels doesn't reject."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one of the smallest doc_id."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document of the smallest doc_id."""
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source up to its target, repeated where the target is larger than the source."""
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit integers) of every row."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix_sources),
    ("byte_bpe", tokenise),
]
#: No SQL: a learned classifier, sampled near copies and the merges of a vocabulary are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored in the shared folder; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
