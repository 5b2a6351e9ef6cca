"""Joining predictions to truth and scoring them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_truth(preds: DataFrame, truth: DataFrame) -> DataFrame:
    """V5: inner join of (row_id, pred) to (row_id, label) on the row key."""
    return preds.join(truth.select("row_id", "label"), "row_id")


def correct(joined: DataFrame) -> DataFrame:
    """the rows predicted right."""
    return joined.where(F.col("pred") == F.col("label"))


def accuracy(joined: DataFrame) -> DataFrame:
    """V4: one row (n_total, n_correct, accuracy_pct) from a single
    aggregation; a NULL prediction counts as wrong."""
    return joined.agg(
        F.count("*").cast("bigint").alias("n_total"),
        F.count_if(F.col("pred") == F.col("label")).cast("bigint").alias("n_correct"),
    ).withColumn("accuracy_pct", F.when(
        F.col("n_total") > 0, F.col("n_correct") * 100.0 / F.col("n_total")))


def limit_rows(points: DataFrame, n: int) -> DataFrame:
    """the n rows with the smallest keys when n > 0, else all rows."""
    return points.orderBy("row_id").limit(n) if n > 0 else points
