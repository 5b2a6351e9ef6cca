"""Equal-width binning of numeric features (E1, E2) and the per-bag value
table (E3).

Bin rule for a numeric feature: ``floor(x / ((max - min) / (nd div 1000)))``
with integer division, and the minimum is *not* subtracted, so bin ids
can be negative. ``max == min`` gives bin 0, as does a numeric feature
with fewer than 1000 distinct values (the bucket count is then 0).
Categorical features pass through. The same encoder is applied to train
and test rows.

The profile has one row per feature position, so it is bounded by the
schema, not the data; it is read once on the driver and turned into one
literal expression per position, which Spark constant-folds into the
projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_PROFILE_ROWS = 100_000


def bin_params(profile: DataFrame) -> list[tuple[int, bool, float | None]]:
    """[(feature, is_categorical, width or None)] ordered by feature."""
    rows = profile.select("feature", "is_categorical", "num_distinct", "min", "max") \
        .orderBy("feature").limit(MAX_PROFILE_ROWS + 1).collect()
    if len(rows) > MAX_PROFILE_ROWS:
        raise ValueError("profile has more rows than any feature vector")
    out = []
    for r in rows:
        if r["is_categorical"] == 1:
            out.append((int(r["feature"]), True, None))
            continue
        nb = int(r["num_distinct"]) // 1000
        span = float(r["max"]) - float(r["min"])
        width = span / nb if nb > 0 and span != 0.0 else None
        out.append((int(r["feature"]), False, width))
    return out


def _bin(x, is_cat: bool, width: float | None):
    if is_cat:
        return x
    if width is None:
        return F.lit(0.0).cast("double")
    return F.floor(x / F.lit(width)).cast("double")


def encode(points: DataFrame, profile: DataFrame, features: str = "features",
           out: str | None = None) -> DataFrame:
    """Replace ``features`` (or add ``out``) with binned values."""
    params = bin_params(profile)
    arr = F.array(*[_bin(F.col(features).getItem(i), c, w) for i, c, w in params])
    return points.withColumn(out or features, arr)


def encode_sql(params, features: str = "features") -> str:
    """DuckDB text of :func:`encode` for given :func:`bin_params`."""
    parts = []
    for i, c, w in params:
        x = f"{features}[{i + 1}]"
        if c:
            parts.append(x)
        elif w is None:
            parts.append("0.0::DOUBLE")
        else:
            parts.append(f"floor({x} / CAST('{w!r}' AS DOUBLE))::DOUBLE")
    return "[" + ", ".join(parts) + "]"


def value_table(bagged: DataFrame, features: str = "features",
                with_labels: bool = False) -> DataFrame:
    """Per (model_id, feature), the sorted distinct encoded values with
    their 0-based position and the distinct count.

    Bounded by models x features x bins (binning caps bins near
    nd/1000 + 1, categoricals at 1000), so the windows here run over
    small groups regardless of row count.
    """
    if with_labels:
        # The label domain rides along as feature -1, so one pass over the
        # bag yields both the value table and the labels.
        arr = F.concat(F.array(F.col("label").cast("double")), F.col(features))
        vals = bagged.select("model_id", F.posexplode(arr).alias("feature", "value")) \
            .withColumn("feature", F.col("feature") - 1).distinct()
    else:
        vals = bagged.select("model_id", F.posexplode(features).alias("feature", "value")) \
            .distinct()
    w = Window.partitionBy("model_id", "feature")
    return vals.select(
        "model_id", F.col("feature").cast("int").alias("feature"), "value",
        (F.dense_rank().over(w.orderBy("value")) - 1).cast("int").alias("pos"),
        F.count("*").over(w).cast("int").alias("n_values"),
    )
