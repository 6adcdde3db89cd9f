"""A corpus pipeline: quality rules, near-copies, benchmark leaks, secrets, packing.

Each stage takes what its predecessor wrote and returns the columns of ``documents``; the last returns packed pieces with
their ids. The stages call the operators in rainfold.llm, whose modules say how nulls, ties and repeats are handled.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rainfold.llm import decontamination, packing, quality_rules, secrets, simhash
from rainfold.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.representatives(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY), packing.CAPACITY, "ids")


STAGES = [("quality rules", quality), ("near copies", near_copies), ("benchmark leaks", leaks), ("secrets", secret_spans), ("packing", packed)]
#: The forest, the tokenizer and the packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
