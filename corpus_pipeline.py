"""Corpus pipeline: quality rules, quality classifier, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but the last keeps the
columns of ``documents``. :func:`run` writes each stage as Parquet to the shared folder and reads it
again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyferry.llm import bpe, decontam, quality_model, quality_rules, simhash
from tallyferry.llm.entries import vocabulary
from tallyferry.llm.shared import read, remove, shared_dir


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the text rules and whose source passes as a host.

    Null, empty and short texts go; repeated rows are judged one by one; a null source is a host of
    its own; no documents give none.
    """
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on all of ``labels`` and ``docs``, keeps.

    Without labels all stay, with labels of one class all or none; rows of one text, language and
    source share a verdict; null texts are scored as empty.
    """
    return quality_model.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates; null and empty texts are one group."""
    return simhash.keep_one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of ``benchmark``; null texts hold none, an empty item table drops none."""
    return decontam.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of token digests for each document; a null text counts as empty."""
    return bpe.bpe_round_trip(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: SQL can express neither the trained classifier nor the encoder; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; only the last stage's table stays in the shared folder."""
    docs, before = read(spark, sf_dir, "documents"), None
    folder = f"{shared_dir(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
