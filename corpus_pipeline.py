"""The training-data pipeline: stages in order, each over all rows that the
one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from copse.llm import stages

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("mixing", stages.mixing),
]

#: The quality and near-duplicate stages have no SQL form that would finish;
#: tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = stages.table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = stages.kept(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
