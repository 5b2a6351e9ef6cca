"""Run reports and prediction output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_report(accuracy: DataFrame, **params) -> DataFrame:
    """The one-row accuracy frame with the run parameters as columns
    (e.g. n_train, k, n_models, fraction, depth, smoothing)."""
    return accuracy.select("*", *[F.lit(v).alias(k) for k, v in sorted(params.items())])


def write_predictions(preds: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write (row_id, pred[, label]) as parquet, one file per task."""
    preds.write.mode(mode).parquet(path)
