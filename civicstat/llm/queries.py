"""Queries of the operators, as (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicstat.llm import (bpe, chat, clusters, language, mixing, quality, rules, secrets, simhash, substrings, topk,
                           toxicity, trie)
from civicstat.llm.common import table


def _on(name: str, digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, name))


def _labelled(digest: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _bpe(documents: DataFrame) -> DataFrame:
    return bpe.bpe_digest(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": _on("conversations", chat.chat_digest),
    "op2_quality_classifier": _labelled(quality.quality_digest),
    "op3_substring_dedup": _on("documents", substrings.substring_digest),
    "op4_simhash": _on("documents", simhash.simhash_digest),
    "op5_toxicity": _labelled(toxicity.toxicity_digest),
    "op6_quality_rules": _on("documents", rules.rules_digest),
    "op7_language_id": _on("documents", language.language_digest),
    "op8_mixing": _on("documents", mixing.mix_digest),
    "op9_exact_top_k": _on("embeddings", topk.topk_digest),
    "op10_byte_bpe": _on("documents", _bpe),
    "op11_secret_scan": _on("documents", secrets.secrets_digest),
    "op12_centroid_clustering": _on("embeddings", clusters.cluster_digest),
    "op13_prefix_trie": _on("conversations", trie.trie_digest),
}

SQL: dict[str, str] = {
    "op1_chat_formatting": chat.SQL,
    "op6_quality_rules": rules.SQL,
    "op8_mixing": mixing.SQL,
    "op9_exact_top_k": topk.SQL,
    "op12_centroid_clustering": clusters.SQL,
    "op13_prefix_trie": trie.SQL,
}
