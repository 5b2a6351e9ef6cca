"""Feature profiling.

One row per feature position: mean, sample std, min, max, distinct count,
the categorical / ordinal flag (at most ``categorical_max`` distinct
values -> categorical) and the stored bucket count. Features are exploded
with their positions and aggregated per position; partial aggregation
happens before the shuffle, so the shuffle carries one partial row per
(task, feature) for the moments and one per (task, feature, value) for
the exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: more distinct values than this makes a feature numeric.
CATEGORICAL_MAX_DISTINCT = 1000

PROFILE_COLUMNS = ["feature", "is_categorical", "is_ordinal", "num_distinct",
                   "min", "max", "mean", "std", "n_buckets"]


def feature_values(points: DataFrame, features: str = "features") -> DataFrame:
    """(feature, value) pairs, one per array element."""
    return points.select(F.posexplode(features).alias("feature", "value"))


def profile(points: DataFrame, features: str = "features", approx: bool = False,
            categorical_max: int = CATEGORICAL_MAX_DISTINCT) -> DataFrame:
    """Profile every feature position of ``points``.

    ``approx=True`` uses HyperLogLog++ for the distinct count, which keeps
    the shuffle to one sketch per (task, feature) at very large scale; the
    categorical flag then depends on an estimate near the threshold.
    """
    fv = feature_values(points, features)
    nd = (F.approx_count_distinct("value") if approx else F.count_distinct("value"))
    stats = fv.groupBy("feature").agg(
        nd.cast("bigint").alias("num_distinct"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    is_cat = F.when(F.col("num_distinct") > categorical_max, F.lit(0)).otherwise(F.lit(1))
    return stats.select(
        F.col("feature").cast("int").alias("feature"),
        is_cat.alias("is_categorical"),
        is_cat.alias("is_ordinal"),
        "num_distinct", "min", "max", "mean", "std",
        F.when(is_cat == 0, (F.col("num_distinct") / 1000).cast("bigint") + 1)
        .otherwise(F.lit(0)).cast("bigint").alias("n_buckets"),
    )


def label_domain(points: DataFrame) -> DataFrame:
    """Distinct labels (F8)."""
    return points.select("label").distinct()
