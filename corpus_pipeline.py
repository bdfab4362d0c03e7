"""From raw documents to packed training sequences.

Each stage takes all documents that the one before kept, and its decisions take effect:

1. ``language``: texts without letters or without a clear language go.
2. ``near_duplicates``: of each group of near duplicates (five-word shingles, similarity 0.8 or
   more) the first document stays.
3. ``decontamination``: benchmark passages are cut out of the texts; all documents stay.
4. ``secrets``: secrets in the texts are replaced by their kind; all documents stay.
5. ``packing``: the texts are tokenized and packed into sequences of 1024 ids.

All but the last return the columns of ``documents``. Null texts go in the first stage and are
handled by the others like empty ones. An empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm import decontamination, language, packing, secret_scan, simhash
from shelfscan.llm.common import prepare, stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.accepted(docs, language.train(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Compression, estimated similarity and tokenizing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
