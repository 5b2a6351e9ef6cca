"""Bagged ensembles of trees, naive Bayes and k-NN with explicit counts.

One profile and one set of bin edges, taken from the training rows, encode
both sides; one bagging pass draws every model's bag (trees first, then
naive Bayes, then k-NN, by model id); the vote is over all models of a row.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.functions.draws import hash52
from copse.operators import bagging, bayes, encode, evaluate, knn, profile, tree, vote
from copse.sources.report import metric_report


def split(points: DataFrame, test_share: float) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint by a hash of the key, all rows used."""
    is_test = hash52(F.col("row_id")).cast("double") < F.lit(float(test_share) * 2.0**52)
    return points.where(~is_test), points.where(is_test)


def run(train: DataFrame, test: DataFrame, n_trees: int = 0, n_nb: int = 0, n_knn: int = 0, k: int = 5,
        fraction: float = 0.7, depth: int = 5, smoothing: float = 1.0, n_test: int = -1, seed: int = 0,
        method: str = "poisson", metric: str = "l2", exclude_self: bool = False,
        feature_profile: DataFrame | None = None) -> DataFrame:
    """(row_id, pred, votes) for the rows of ``test`` (the ``n_test`` with the
    smallest keys, all if not positive).

    ``feature_profile`` is a stored profile of the training rows; without
    one they are profiled. ``exclude_self`` keeps a k-NN query from finding
    its own row, for a test on training rows.
    """
    n_models = n_trees + n_nb + n_knn
    if min(n_trees, n_nb, n_knn) < 0 or n_models < 1:
        raise ValueError("model counts must not be negative, and at least one positive")
    prof = profile.profile(train) if feature_profile is None else feature_profile
    n_features = prof.count()
    points = encode.encode(train, prof).select("row_id", "label", "features")
    by_row = method != "keep_or_replace"
    if by_row:
        points = bagging.drawn(points, n_models, fraction, seed, method)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    queries = encode.encode(evaluate.limit_rows(test, n_test), prof)
    try:
        bag = bagging.spread_bags(points) if by_row else bagging.bags(points, n_models, fraction, seed, method)
        of = lambda lo, n: bag.where(F.col("model_id").between(lo, lo + n - 1))
        preds = []
        if n_trees:
            nodes = tree.fit(of(0, n_trees), depth, seed, persist=method == "keep_or_replace")
            preds.append(tree.predict(nodes, queries, depth, list(range(n_trees))))
        if n_nb:
            preds.append(bayes.predict(bayes.fit(of(n_trees, n_nb)), queries, n_features, alpha=smoothing))
        if n_knn:
            first = n_trees + n_nb
            preds.append(knn.bagged_predict(of(first, n_knn), queries, k, metric, n_knn, exclude_self, first))
        return vote.majority(vote.union_predictions(*preds))
    finally:
        points.unpersist()


def report(votes: DataFrame, truth: DataFrame, **parameters) -> DataFrame:
    """One row: accuracy with both counts, and the run's parameters."""
    return metric_report(evaluate.accuracy(evaluate.with_truth(votes, truth)), **parameters)
