"""From raw documents to token ids: the corpus operators as stages over stored tables.

Every stage takes (spark, docs, sf_dir) and gives back the columns of ``documents``; the last one
adds token ids. ``run`` writes each result as Parquet to the shared folder and the next stage reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import bpe, mixing, neardup, quality, secrets
from basketlens.session import configure, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like text of some language."""
    return quality.assessed(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every component of near-duplicates."""
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a placeholder for every secret found; n_chars counts the new text."""
    return secrets.scanned(docs, redacting=True)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens and ids."""
    return bpe.with_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: The conditional random field and the tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"stage{place}")
    return docs
