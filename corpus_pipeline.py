"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and works on every row it is given. All
but the last return the columns of documents, whatever else they are named.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendlight.llm import backtrack_bpe, mixing, probminhash, secret_scan, toxicity
from spendlight.llm.store import stored, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't reject."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id."""
    return probminhash.deduplicated(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live secrets in their texts replaced."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the target weights takes it."""
    return mixing.emitted_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of each document of the mix."""
    return backtrack_bpe.encode(docs, RANKS)


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_near_copies", drop_near_copies),
    ("hide_secrets", hide_secrets),
    ("mix_sources", mix_sources),
    ("encode_texts", encode_texts),
]

#: The stages hold a trained classifier and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
