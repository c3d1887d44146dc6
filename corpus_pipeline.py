"""A corpus from raw documents to token digests in five stages, each over all that its predecessor kept.

Rows with a null doc_id or a null text go through every stage as the stage defines: a null text is judged and encoded as
an empty one, is no near duplicate and holds neither a benchmark item nor a secret. An empty table gives an empty result.
Columns of any name are kept up to the last stage, which returns token counts and digests.
"""

from __future__ import annotations

from lodestack.llm.bpe import bpe_round_trip
from lodestack.llm.common import cut, table
from lodestack.llm.decontaminate import clean_documents
from lodestack.llm.near_dedup import keep_one
from lodestack.llm.quality import accepted_documents
from lodestack.llm.secrets import redact_documents
from pyspark.sql import DataFrame, SparkSession


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return accepted_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, cut(table(spark, sf_dir, "benchmark").select("item_id", "text"), "items"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; all documents stay."""
    return redact_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the clean documents."""
    return bpe_round_trip(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("bpe", bpe)]

#: a trained classifier and a tokenizer are not SQL; tests/llm/test_pipeline.py holds the whole run against plain versions of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
