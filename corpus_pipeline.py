"""The document pipeline: quality, near-duplicates, benchmark leaks, secrets, token ids.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of docs as they came, further ones included.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.llm import bpe, neardup, quality, secrets, templates
from tracesieve.llm.common import cut, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates."""
    return neardup.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark."""
    return templates.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts secrets out of the texts; keeps all documents."""
    return secrets.put_out(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids and n_tokens."""
    out = bpe.with_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return out.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality", good),
    ("near_duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("secrets", without_secrets),
    ("token_ids", encoded),
]

#: Near-duplicate classes and token ids can't be told in SQL; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
