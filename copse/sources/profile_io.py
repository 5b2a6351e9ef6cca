"""Feature-profile files.

Format, one line per feature in feature order, no header:
``is_categorical,is_ordinal,num_distinct,min,max``.

A profile has one row per feature position, so it is bounded by the
schema; it is written as a single small text file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_profile(profile: DataFrame, path: str) -> None:
    """Write the five-field lines, ordered by feature."""
    lines = profile.orderBy("feature").select(F.concat_ws(
        ",", F.col("is_categorical").cast("string"), F.col("is_ordinal").cast("string"),
        F.col("num_distinct").cast("string"), F.col("min").cast("string"),
        F.col("max").cast("string")).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Read five-field lines; the line position is the feature index.

    Columns as produced by ``profile.profile`` (mean/std are not stored in
    the file and come back NULL); ``n_buckets`` is recomputed by the rule
    nd div 1000 + 1 for numeric features."""
    # Several part files count in name order (Spark may scan them in another
    # one); within a split, ids increase in line order. The ranking runs over
    # the profile's own rows (one per feature).
    raw = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(
        "value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("line")).alias("__pos"))
    parts = F.split(F.trim("value"), ",")
    prof = raw.select(
        (F.row_number().over(Window.orderBy("__pos")) - 1).cast("int").alias("feature"),
        parts.getItem(0).cast("int").alias("is_categorical"),
        parts.getItem(1).cast("int").alias("is_ordinal"),
        parts.getItem(2).cast("bigint").alias("num_distinct"),
        parts.getItem(3).cast("double").alias("min"),
        parts.getItem(4).cast("double").alias("max"),
    )
    return prof.select(
        "*", F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("std"),
        F.when(F.col("is_categorical") == 0, (F.col("num_distinct") / 1000).cast("bigint") + 1)
        .otherwise(F.lit(0)).cast("bigint").alias("n_buckets"))

