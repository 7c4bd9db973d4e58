"""The corpus pipeline: quality, language, near-duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
all but the last return the columns of ``documents``.  Stage functions raise
nothing on null, empty or repeated rows; see the operators for their results.
No stage is expressible in SQL as a whole (a trained network, learnt filters,
signatures, a tokenizer), so ``ORACLE_SQL`` is None and the tests check the
stages against the operators' brute-force versions.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from likeness.llm.common import bounded_batches, materialize, table
from likeness.llm.language import keep_identified
from likeness.llm.near_duplicates import keep_one
from likeness.llm.packing import pack_documents
from likeness.llm.quality import keep_good
from likeness.llm.secret_scan import redact_secrets

TOKENIZER = os.environ.get("LIKENESS_TOKENIZER", public_tokenizers.path("word_bpe_49k.json"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("secrets", secrets), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
