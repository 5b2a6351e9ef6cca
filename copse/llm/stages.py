"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and gives
a DataFrame with the columns of ``docs``; the last adds the copy number.

Columns of ``docs`` other than doc_id, text and source are carried, never
read; the labels and the benchmark come from ``sf_dir``. Each stage works on
all rows that it is given; empty tables, nulls and repeated rows are handled
as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from copse.llm import decontam, neardup, pii, quality
from copse.llm import mixing as mixer
from copse.llm.queries import SEED, table
from copse.llm.scratch import Steps


def kept(df: DataFrame, name: str) -> DataFrame:
    """A stage's rows, written and read again."""
    return Steps(df.sparkSession, "pipeline").save(df, name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return neardup.dedupe(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the kind in brackets."""
    return pii.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, with its number from 1 on."""
    return mixer.mix(docs, SEED)
