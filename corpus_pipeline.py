"""Corpus pipeline: every stage takes the documents that the stage before kept.

All stages but the last return the columns of documents. Each result is
written as Parquet and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from civicstat.llm import bpe, common, mixing, rules, simhash, substrings


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts go (too short);
    repeated rows share a verdict; an empty table stays empty."""
    found, verdict = rules.screen(docs)
    return found.where(F.col(f"{verdict}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows. A text that loses no
    word stays as it is; the others are their words joined by one space, with
    n_chars counted again."""
    found, d = substrings.dedup(docs)
    cut = F.col(f"{d}.n_removed") > 0
    found = found.withColumn("text", F.when(cut, F.col(f"{d}.kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(cut, n).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: null sources are a source,
    null ids share one key, empty texts count no words and stay as often as
    their key says; an empty table stays empty."""
    mixed, m = mixing.mix(docs)
    each, = common.fresh(mixed, "epoch")
    return (mixed.where(F.col(f"{m}.copies") > 0)
            .withColumn(each, F.explode(F.sequence(F.lit(1), F.col(f"{m}.copies")))).select(*docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and of the decoded bytes, row by row; null
    and empty texts have no ids; an empty table stays empty."""
    return bpe.bpe_digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express near duplicates and byte pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
