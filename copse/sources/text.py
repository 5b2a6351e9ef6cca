"""Ranked-feature text: ``label qid:Q 1:v1 2:v2 ...`` (space separated).

Parsing is a single projection of native, code-generated expressions
(``regexp_extract``, ``rlike``, ``regexp_extract_all``, an array
``try_cast``); no Python and no per-token lambda runs per line. As in the
input format, a feature's position is its identity: the index before the
colon is not used.

Malformed lines (label not an integer, a token that is not ``i:v``, a
value that is not a number, a wrong feature count) are handled by mode:
``fail`` raises inside the job, ``drop`` filters them out, ``quarantine``
returns them as a second frame with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POINT_COLUMNS = ["row_id", "label", "qid", "features"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text scan of a file, directory, glob or list of those (one row per line)."""
    return spark.read.text(path)


# The ranked-line grammar. Tokens are separated by spaces;
# the first is the label, the second "qid:Q"; every later token is
# "index:value" with exactly one colon (the index is not used).
FIRST_TOKEN = r"^\s*(\S+)"
SECOND_TOKEN = r"^\s*\S+\s+(\S+)"
AFTER_TWO = r"^\s*\S+\s+\S+\s*(.*)$"
# Possessive, so a line of any number of pairs is checked by a loop and not
# by recursion.
PAIR_LIST = r"^(?:[^\s:]*+:[^\s:]++(?:\s++|$))*+$"
PAIR_VALUE = r"[^\s:]*:([^\s:]+)"


def content_row_id(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Row key when the caller has none: md5 (128 bits, as text) of the line's
    md5 and its ordinal among identical lines.

    Identical lines are interchangeable, so any assignment of ordinals to
    copies yields the same set of (id, line) pairs; the result does not
    depend on partitioning. Copies are counted per input split first, over
    hashes instead of lines, and offsets come from those per-split counts,
    so a line repeated across a third of the input is never gathered into
    one task.
    """
    split = F.concat_ws("@", F.col("_metadata.file_path"),
                        F.col("_metadata.file_block_start").cast("string"))
    lines = df.select(F.col(text_col).alias("__line"), F.md5(text_col).alias("__h"), split.alias("__split"))
    rows = lines.withColumn(
        "__pos", F.row_number().over(Window.partitionBy("__h", "__split").orderBy("__h")))
    counts = lines.groupBy("__h", "__split").agg(F.count("*").alias("__n"))
    offsets = counts.withColumn(
        "__off",
        F.coalesce(F.sum("__n").over(Window.partitionBy("__h").orderBy("__split")
                                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = rows.join(offsets.drop("__n"), ["__h", "__split"])
    ordinal = (F.col("__off") + F.col("__pos")).cast("string")
    return joined.select(F.md5(F.concat_ws("|", "__h", ordinal)).alias("row_id"),
                         F.col("__line").alias(text_col))


def parse_ranked(df: DataFrame, text_col: str = "value", key: str | None = None,
                 with_qid: bool = True, n_features: int | None = None,
                 mode: str = "drop"):
    """Parse ranked lines into ``(row_id, label, qid, features ARRAY<DOUBLE>)``.

    ``key`` names a unique row key column already on ``df``, kept with its
    type; without one the key is the text from :func:`content_row_id` (which
    needs a file scan). A line without features, or with a value that is not
    a number, is malformed. With
    ``with_qid=False`` the second token is skipped without being read, as
    in the plain (label, features) parser; ``qid`` is then NULL.

    Returns the points frame, or ``(points, rejects)`` for
    ``mode="quarantine"``.
    """
    if mode not in ("fail", "drop", "quarantine"):
        raise ValueError("mode must be fail, drop or quarantine")
    if key is None:
        df = content_row_id(df, text_col)
        key = "row_id"
    line = F.col(text_col)
    tokens = F.array(F.struct(F.regexp_extract(line, FIRST_TOKEN, 1).alias("label"),
                              F.regexp_extract(line, SECOND_TOKEN, 1).alias("qid"),
                              F.regexp_extract(line, AFTER_TWO, 1).alias("rest")))

    def read(t):
        # Whole-line native expressions (no per-token lambdas): one regex to
        # validate the pair list, one to pull the values, an array cast.
        return F.struct(
            t["label"].try_cast("bigint").alias("label"),
            (F.when(t["qid"].rlike(r"^[^:]*:[^:]+$"), F.regexp_extract(t["qid"], r":(.*)$", 1).try_cast("bigint"))
             if with_qid else F.lit(None).cast("bigint")).alias("qid"),
            F.regexp_extract_all(t["rest"], F.lit(PAIR_VALUE), 1).try_cast("array<double>").alias("features"),
            (t["qid"] != F.lit("")).alias("__has_qid"),
            t["rest"].rlike(PAIR_LIST).alias("__pairs_ok"))

    # A generator of one row: what is judged and selected above it is computed
    # once a line, as filters are not pushed below it.
    parsed = df.select(F.col(key).alias("row_id"), line.alias("__line"), F.inline(F.transform(tokens, read)))
    reason = (
        F.when(F.col("label").isNull(), F.lit("bad label"))
        .when(~F.col("__has_qid"), F.lit("missing qid token"))
        .when(F.lit(with_qid) & F.col("qid").isNull(), F.lit("bad qid"))
        .when(~F.col("__pairs_ok"), F.lit("bad feature"))
        .when(F.size(F.array_compact("features")) != F.size("features"), F.lit("bad feature"))
        .when(F.exists("features", F.isnan), F.lit("bad feature"))
        .when(F.size("features") == 0, F.lit("no features"))
    )
    if n_features is not None:
        reason = reason.when(F.size("features") != n_features, F.lit("wrong feature count"))
    checked = parsed.withColumn("__reason", reason)
    points_cols = [F.col(c) for c in POINT_COLUMNS]
    if mode == "fail":
        out = checked.withColumn(
            "__ok", F.when(F.col("__reason").isNull(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("malformed line: "), F.col("__reason"),
                                       F.lit(": "), F.col("__line")))))
        return out.where(F.col("__ok")).select(*points_cols)
    good = checked.where(F.col("__reason").isNull()).select(*points_cols)
    if mode == "drop":
        return good
    bad = checked.where(F.col("__reason").isNotNull()).select(
        "row_id", F.col("__line").alias("line"), F.col("__reason").alias("reason"))
    return good, bad


def format_ranked(points: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_ranked`: points back to ranked text
    (``value`` column), keeping ``row_id`` alongside."""
    pairs = F.transform("features", lambda v, i: F.concat((i + 1).cast("string"), F.lit(":"),
                                                           v.cast("string")))
    return points.select(
        "row_id",
        F.concat_ws(" ", F.col("label").cast("string"),
                    F.concat(F.lit("qid:"), F.coalesce(F.col("qid"), F.lit(0)).cast("string")),
                    F.array_join(pairs, " ")).alias("value"))
