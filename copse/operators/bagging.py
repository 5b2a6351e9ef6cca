"""Bootstrap bags for many models at once.

A bag is a frame ``(model_id, row_id, w, ...point columns)`` where ``w``
is how many times the row is in the bag. Rows are replicated per model
with ``explode(sequence(0, m - 1))`` (a generator, not a join), and each
(model, row) gets its own md5 draw, so every bag is reproducible from
(seed, model_id, row_id) alone and independent of partitioning.

* ``bernoulli``: without replacement, keep when u < fraction (B1)
* ``poisson``: with replacement, w ~ Poisson(fraction) by inverse CDF (B2)
* ``keep_or_replace``: each row is kept, or replaced by a uniformly drawn
  row when u > fraction (B3)
* ``fixed_sample``: n rows without replacement, smallest draws first (B4)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from copse.functions.draws import hash52, hash_range, poisson_weight, uniform
from copse.plans.broadcast import bounded_broadcast


def _per_model(points: DataFrame, n_models: int) -> DataFrame:
    if n_models < 1:
        raise ValueError("n_models must be >= 1")
    return points.withColumn("model_id", F.explode(F.sequence(F.lit(0), F.lit(n_models - 1))))


def bernoulli(points: DataFrame, n_models: int, fraction: float, seed: int) -> DataFrame:
    per = _per_model(points, n_models)
    keep = uniform(seed, F.col("model_id"), F.col("row_id")) < F.lit(float(fraction))
    return per.where(keep).withColumn("w", F.lit(1).cast("int"))


def poisson(points: DataFrame, n_models: int, fraction: float, seed: int) -> DataFrame:
    per = _per_model(points, n_models)
    w = poisson_weight(uniform(seed, F.col("model_id"), F.col("row_id")), float(fraction))
    return per.withColumn("w", w).where(F.col("w") > 0)


def drawn(points: DataFrame, n_models: int, fraction: float, seed: int, method: str) -> DataFrame:
    """``points`` with ``ws``, the weights of a row in the bags of ``bernoulli`` or
    ``poisson`` by model: kept with cached points, draws are made once for
    however many passes over the bags (``spread_bags``)."""
    if n_models < 1:
        raise ValueError("n_models must be >= 1")
    us = F.transform(F.sequence(F.lit(0), F.lit(n_models - 1)), lambda m: uniform(seed, m, F.col("row_id")))
    if method == "poisson":
        return points.withColumn("ws", F.transform(us, lambda u: poisson_weight(u, float(fraction))))
    if method == "bernoulli":
        return points.withColumn("ws", F.transform(us, lambda u: (u < F.lit(float(fraction))).cast("int")))
    raise ValueError(f"no weights by row for bagging method {method!r}")


def spread_bags(points: DataFrame) -> DataFrame:
    """The bags of ``drawn`` points, in one frame as of ``bags``."""
    return points.select(*[c for c in points.columns if c != "ws"], F.posexplode("ws").alias("model_id", "w")) \
        .where(F.col("w") > 0)


ROWS_PER_BUCKET = 1_000_000


def ordinals(points: DataFrame, n_buckets: int = 1024,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """Dense ordinals 0..N-1 over ``row_id`` without a single-partition window.

    The order is that of (hash of the key, key). Hash ranges are numbered
    by ``row_number`` each and shifted by the running count of the earlier
    ranges, so the ordinals do not depend on the number of ranges. That
    number is ``n_buckets`` or more: it grows
    with the data so that no bucket (one window partition, one task) holds
    more than about ``rows_per_bucket`` rows. The bucket-count table has
    one row per bucket (at most N / rows_per_bucket + n_buckets rows), so
    its broadcast is bounded. Keys are unique, so buckets are balanced
    whatever the key distribution. Returns (ordinals, N).
    """
    n_rows = points.count()
    buckets = max(n_buckets, -(-n_rows // rows_per_bucket))
    b = points.select("row_id", hash52(F.col("row_id")).alias("h")) \
        .withColumn("bucket", hash_range(F.col("h"), buckets))
    within = b.withColumn(
        "rn", F.row_number().over(Window.partitionBy("bucket").orderBy("h", "row_id")) - 1)
    counts = b.groupBy("bucket").agg(F.count("*").alias("n"))
    # Running total over the bucket-count table (one row per bucket).
    offsets = counts.coalesce(1).withColumn(
        "offset",
        F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).select("bucket", "offset")
    out = within.join(bounded_broadcast(offsets, buckets), "bucket") \
        .select("row_id", (F.col("offset") + F.col("rn")).cast("bigint").alias("ordinal"))
    return out, n_rows


def keep_or_replace_slots(points: DataFrame, n_models: int, fraction: float, seed: int,
                          n_buckets: int = 1024) -> DataFrame:
    """Every row of every bag is kept when u_keep <= fraction, else it is
    replaced by the row at ordinal floor(u_pick * N). Output has one row
    per slot: ``(model_id, slot_id, row_id, w=1, ...point columns)`` where
    ``slot_id`` is the original row's key and ``row_id`` the drawn row.

    Kept slots need no join; replaced slots are resolved by an equi-join
    on the drawn ordinal, shuffled on that ordinal (draws are uniform, so
    no hot key arises)."""
    ords, n_rows = ordinals(points, n_buckets)
    per = _per_model(points.select("row_id"), n_models)
    u_keep = uniform(seed, F.col("model_id"), F.concat(F.lit("k"), F.col("row_id").cast("string")))
    u_pick = uniform(seed, F.col("model_id"), F.concat(F.lit("p"), F.col("row_id").cast("string")))
    drawn = per.select(
        "model_id", F.col("row_id").alias("slot_id"),
        F.when(u_keep <= F.lit(float(fraction)), F.lit(None).cast("bigint"))
        .otherwise(F.floor(u_pick * F.lit(n_rows)).cast("bigint")).alias("pick"))
    kept = drawn.where(F.col("pick").isNull()).select(
        "model_id", "slot_id", F.col("slot_id").alias("row_id"))
    replaced = drawn.where(F.col("pick").isNotNull()).join(
        ords.withColumnRenamed("ordinal", "pick"), "pick").select("model_id", "slot_id", "row_id")
    return kept.unionByName(replaced)


def keep_or_replace(points: DataFrame, n_models: int, fraction: float, seed: int,
                    n_buckets: int = 1024) -> DataFrame:
    slots = keep_or_replace_slots(points, n_models, fraction, seed, n_buckets)
    return slots.join(points, "row_id").withColumn("w", F.lit(1).cast("int"))


def fixed_sample(points: DataFrame, n: int, seed: int) -> DataFrame:
    """N distinct rows, those with the smallest draws (ties by key).

    The limit is the operator itself; Spark plans it as a per-partition
    top-n followed by a merge of at most n rows per partition."""
    u = uniform(seed, F.lit(0), F.col("row_id"))
    return points.withColumn("u", u).orderBy("u", "row_id").limit(n).drop("u")


def bags(points: DataFrame, n_models: int, fraction: float, seed: int,
         method: str = "poisson") -> DataFrame:
    """All bags in one frame; ``method`` picks B1, B2 or B3."""
    if method == "bernoulli":
        return bernoulli(points, n_models, fraction, seed)
    if method == "poisson":
        return poisson(points, n_models, fraction, seed)
    if method == "keep_or_replace":
        slots = keep_or_replace_slots(points, n_models, fraction, seed)
        weights = slots.groupBy("model_id", "row_id").agg(F.count("*").cast("int").alias("w"))
        return weights.join(points, "row_id")
    raise ValueError(f"unknown bagging method {method!r}")
