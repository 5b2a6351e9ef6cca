"""Combining per-model predictions (V2, V3).

Predictions are rows ``(model_id, row_id, pred)``. The vote is two
grouped aggregations on the row key: counts per (row, label), then the
label with the most votes, smallest label on ties. The first aggregation
is partial before the shuffle, so the shuffle carries at most one row per
(task, row, label).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.functions.argmax import argmax_label


def union_predictions(*frames: DataFrame) -> DataFrame:
    """V3: stack per-model predictions (model ids must already be distinct)."""
    return reduce(DataFrame.unionByName,
                  [f.select("model_id", "row_id", "pred") for f in frames])


def vote_counts(preds: DataFrame) -> DataFrame:
    return preds.where(F.col("pred").isNotNull()).groupBy("row_id", "pred") \
        .agg(F.count("*").alias("votes"))


def majority(preds: DataFrame) -> DataFrame:
    """V2: (row_id, pred, votes) with the winning label per row."""
    counts = vote_counts(preds)
    return counts.groupBy("row_id").agg(
        argmax_label("pred", "votes").alias("pred"),
        F.max("votes").alias("votes"))
