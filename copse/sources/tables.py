"""Labelled points from the driver's parquet tables.

Each builder is a projection of one scan, so Catalyst prunes the parquet
read to the columns named here (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copse.plans.partitioning import spread

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# The order features, in array position order.
ORDER_FEATURES = ["o_totalprice", "order_year", "order_month", "order_day",
                  "status_code", "o_custkey"]
# Order status letters mapped to codes F=0, O=1, P=2.
ORDER_STATUS_CODES = {"F": 0, "O": 1, "P": 2}

# The lineitem features, in array position order.
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "returnflag_code"]
# Return flag letters mapped to codes A=0, N=1, R=2.
RETURNFLAG_CODES = {"A": 0, "N": 1, "R": 2}

# Document features, in array position order.
DOCUMENT_FEATURES = ["lang_code", "source_code", "length_band", "line_band"]
# Language tags mapped to codes.
LANG_CODES = {"de": 0, "en": 1, "es": 2, "fr": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(col: str, codes: dict) -> F.Column:
    expr = None
    for k, v in codes.items():
        expr = (F.when if expr is None else expr.when)(F.col(col) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(-1))


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (row_id, label, qid, features): label is the leading digit of
    the priority minus one (five classes 0..4), qid the customer."""
    o = table(spark, sf_dir, "orders")
    feats = F.array(
        F.col("o_totalprice").cast("double"),
        F.year("o_orderdate").cast("double"),
        F.month("o_orderdate").cast("double"),
        F.dayofmonth("o_orderdate").cast("double"),
        _code("o_orderstatus", ORDER_STATUS_CODES).cast("double"),
        F.col("o_custkey").cast("double"),
    )
    return spread(o.select(
        F.col("o_orderkey").cast("bigint").alias("row_id"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") - 1).alias("label"),
        F.col("o_custkey").cast("bigint").alias("qid"),
        feats.alias("features"),
    ), "row_id")


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> (label, features). lineitem has no unique key, so no
    row_id: only key-free operators (profile, gini by group) use it.
    label = quantity band floor((q - 1) / 10), five classes for q in 1..50."""
    li = table(spark, sf_dir, "lineitem")
    feats = F.array(
        F.col("l_quantity").cast("double"),
        F.col("l_extendedprice").cast("double"),
        F.col("l_discount").cast("double"),
        F.col("l_tax").cast("double"),
        _code("l_returnflag", RETURNFLAG_CODES).cast("double"),
    )
    return spread(li.select(
        F.col("l_returnflag").alias("group_key"),
        F.floor((F.col("l_quantity") - 1) / 10).cast("bigint").alias("label"),
        feats.alias("features"),
    ), "features")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> (row_id, label, qid NULL, features ARRAY<DOUBLE>)."""
    e = table(spark, sf_dir, "embeddings")
    return spread(e.select(
        F.col("vec_id").cast("bigint").alias("row_id"),
        F.col("label").cast("bigint").alias("label"),
        F.lit(None).cast("bigint").alias("qid"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
    ), "row_id")


def _log2_band(n: F.Column) -> F.Column:
    """floor(log2(n)) for n >= 1 from the binary digit count (exact integer
    arithmetic, so no floating-point log is involved)."""
    return (F.length(F.bin(F.greatest(n.cast("bigint"), F.lit(1)))) - 1).cast("double")


def all_document_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> categorical features for naive Bayes, every row; label
    NULL. The whole text is measured (its length and its line count)."""
    d = table(spark, sf_dir, "documents")
    n_lines = F.length("text") - F.length(F.regexp_replace("text", "\n", "")) + 1
    feats = F.array(
        _code("lang", LANG_CODES).cast("double"),
        F.regexp_extract("source", r"(\d+)$", 1).try_cast("double"),
        _log2_band(F.col("n_chars")),
        _log2_band(n_lines),
    )
    return d.select(
        F.col("doc_id").cast("bigint").alias("row_id"),
        F.lit(None).cast("bigint").alias("label"),
        F.lit(None).cast("bigint").alias("qid"),
        feats.alias("features"),
    )


def document_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents' points; label = quality (0/1, unbalanced)."""
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"),
                                                F.col("quality").cast("bigint").alias("label"))
    return all_document_points(spark, sf_dir).drop("label").join(lab, "row_id") \
        .select("row_id", "label", "qid", "features")


def as_points(df: DataFrame, features: str = "features") -> DataFrame:
    """accept an ML vector column (dense or sparse) and densify it to
    ``ARRAY<DOUBLE>`` with the JVM-side ``vector_to_array``; array columns
    are cast to ``ARRAY<DOUBLE>``."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    dtype = df.schema[features].dataType
    if isinstance(dtype, VectorUDT):
        return df.withColumn(features, vector_to_array(F.col(features), "float64"))
    return df.withColumn(features, F.col(features).cast("array<double>"))
