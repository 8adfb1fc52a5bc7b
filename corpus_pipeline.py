"""Corpus cleaning, stage by stage: every stage reads what its predecessor stored and stores what it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkwright.llm import bpe, decontam, minhash, rules
from linkwright.session import tune, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learnt from the labelled ones among them, does not reject (score 0.3 or more).

    Null and empty texts are scored like any other text; equal texts get equal scores; a null doc_id changes nothing. Without
    two kinds of labels the score is a constant. All columns stay.
    """
    return rules.accepted(docs, tune(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that with the smallest doc_id.

    Null and empty texts are linked with nothing, and so are rows with a null doc_id: they stay. Of repeated rows one stays.
    All columns stay.
    """
    tune(spark)
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a share of benchmark windows that makes them contaminated.

    A null text has no words and stays; rows are treated one by one, whatever their doc_id. An empty benchmark contaminates
    nothing. All columns stay.
    """
    return decontam.clean(docs, tune(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left as token ids, with the digests of ids and decoded text.

    A null text counts as empty; rows are treated one by one.
    """
    tune(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", tokens),
]

#: A trained model and a similarity search cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
