"""Keeping CPU-heavy work spread over the cluster's cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def parallelism(spark) -> int:
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return max(n, spark.sparkContext.defaultParallelism)
    except Exception:  # sessions without a local SparkContext handle
        return n


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition ``df`` on ``keys`` when it has fewer partitions than
    the session has cores, and leave it alone otherwise.

    A small file scans as one partition (one row group is one split), which
    would run everything up to the first shuffle in one task; a large input
    already has thousands of splits and is not shuffled here. Hashing on a
    stable key (not round robin) keeps a recomputed partition identical.
    An explicit partition count is also kept by AQE, which would otherwise
    coalesce a small but CPU-heavy shuffle into one task.
    """
    n = parallelism(df.sparkSession)
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan: leave partitioning to Spark
        return df
    if current >= n:
        return df
    return df.repartition(n, *keys)
