"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendlight.llm import (
    backtrack_bpe, grid_order, huffman, imatch, lexical_search, licenses, mixing, personal_data, prefix_trie, probminhash,
    secret_scan, token_counts, toxicity,
)
from spendlight.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op6_backtrack_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return backtrack_bpe.round_trip_digests(backtrack_bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.written_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_hits(table(spark, sf_dir, "documents"))


def op10_grid_order_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_blockmax_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_ftrl_toxicity,
        op2_imatch_fingerprints,
        op3_token_counts,
        op4_source_mix,
        op5_secret_scan,
        op6_backtrack_bpe,
        op7_huffman_ids,
        op8_probminhash_dedup,
        op9_license_scan,
        op10_grid_order_vectors,
        op11_blockmax_search,
        op12_prefix_trie,
        op13_personal_data,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_imatch_fingerprints": imatch.oracle(),
        "op4_source_mix": mixing.oracle(),
        "op9_license_scan": licenses.oracle(),
        "op10_grid_order_vectors": grid_order.oracle(),
        "op11_blockmax_search": lexical_search.oracle(),
        "op12_prefix_trie": prefix_trie.oracle(),
    }
