"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.  All but the last return
the columns of ``documents``:

1. language: documents in none of the learned languages go (null, without letters, or no language's text);
2. near_duplicates: of each group of near duplicates one document stays;
3. repeated_passages: words covered by a repeated window of 35 words are taken out of the texts;
4. secrets: secrets in the texts are replaced by a marker;
5. packing: the texts' token ids as pieces of sequences of at most 2048.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import base, crossparse_lang, kk_packing, random_secrets, simhash_trie, superkmer_dedup
from tessera.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return crossparse_lang.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash_trie.keep_one(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return superkmer_dedup.remove_repeats(spark, docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return random_secrets.redact(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return kk_packing.pack(docs, public_tokenizers.path(kk_packing.TOKENIZER_FILE))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("secrets", secrets), ("packing", packing)]

#: SQL can express neither the language model nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = base.written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
