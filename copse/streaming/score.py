"""Scoring a stream against fitted trees or naive Bayes.

Fitting is a batch job; scoring with a fitted tree ensemble is row-local,
so it runs on a streaming frame as a stateless projection: each model is
a compiled CASE WHEN over the encoded features, and the vote over models
is an array expression within the row. No state store, no watermark and
no shuffle are involved, so the query can run in append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.operators import bayes
from copse.operators.encode import encode
from copse.operators.tree import compile_trees, vote_expression


def score_trees(stream: DataFrame, nodes: DataFrame, profile: DataFrame | None = None,
                features: str = "features") -> DataFrame:
    """Append ``preds`` (per-model labels) and ``pred`` (majority) to every
    row of ``stream`` (batch or streaming)."""
    exprs = compile_trees(nodes, features="__enc")
    src = stream.withColumn("__enc", F.col(features))
    if profile is not None:
        src = encode(src, profile, features="__enc")
    preds = F.array(*[exprs[m] for m in sorted(exprs)])
    return src.withColumn("preds", preds).withColumn("pred", vote_expression(F.col("preds"))) \
        .drop("__enc")


def score_bayes(stream: DataFrame, model: dict, n_features: int,
                profile: DataFrame | None = None, kind: str = "laplace", alpha: float = 1.0,
                smoothing: float = 1.0, features: str = "features") -> DataFrame:
    """Append ``preds`` (per-model labels, by model id) and ``pred``
    (majority) to every row, with the naive-Bayes model compiled into
    row-local expressions (no join, no aggregation, no state)."""
    src = stream.withColumn("__enc", F.col(features))
    if profile is not None:
        src = encode(src, profile, features="__enc")
    scores, slots = bayes.compile_scores(model, n_features, kind, alpha, smoothing, "__enc")
    preds, _ = bayes.decide_expression(scores, slots)
    return src.withColumn("preds", preds).withColumn("pred", vote_expression(F.col("preds"))) \
        .drop("__enc")


def start_scoring(stream: DataFrame, nodes: DataFrame, sink_path: str, checkpoint: str,
                  profile: DataFrame | None = None, trigger_seconds: int | None = None):
    """Run :func:`score_trees` on a stream into a parquet sink. The
    streaming checkpoint must be a shared folder, like every checkpoint."""
    scored = score_trees(stream, nodes, profile).select("row_id", "pred")
    w = scored.writeStream.format("parquet").option("path", sink_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
