"""Mixing sources to target weights.

Sizes are aggregated per source, repetition rates follow from the targets,
and each document is emitted ``floor(rate)`` times plus one copy drawn by
a hash-seeded Bernoulli trial with the rate's fraction as probability.

Rows that meet in one task: the table of sources (one row per source), for
their rank and for the water level. Documents are never grouped; a source
with a third of all rows is only summed (partially, before the shuffle).

Defined cases: a null text has size 0; a null source is a source of its
own, the last in order; rows equal in id and text draw alike; an empty
table gives an empty plan and an empty mix. Columns of the input with the
names used here are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from copse.llm.scratch import Steps, broadcast_if_small

#: Weights that the sources get in order, repeating.
WEIGHTS = (1, 2, 3)
#: A target stops at this many times its source's size.
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_plan(docs: DataFrame, source: str = "source", text: str = "text",
                weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source, source_size, weight, target, rate.

    The targets share the sum of all sizes by weight; a target above
    ``max_repeats`` times its source's size stops there and the excess is
    shared again by weight among the others. With sources in order of
    size / weight, the capped ones are a prefix; the level of the rest is
    what the prefix leaves, per unit of remaining weight.
    """
    per = docs.groupBy(F.col(source).alias("source")) \
        .agg(F.sum(n_words(F.col(text))).alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int")))
    by_cap = W.orderBy((F.col("source_size") / F.col("weight")).asc(),
                       F.col("source").asc_nulls_last())
    before, everything = by_cap.rowsBetween(W.unboundedPreceding, -1), \
        by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.col("source_size") * max_repeats
    per = (per
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("rest", F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
           .withColumn("rest_weight", F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("capped", cap / F.col("weight") <= F.col("rest") / F.col("rest_weight")))
    level = F.first(F.when(~F.col("capped"), F.struct("rest", "rest_weight")),
                    ignorenulls=True).over(everything)
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(
        F.col("weight") * F.col("level.rest") / F.col("level.rest_weight"))
    return per.withColumn("level", level).select(
        "source", "source_size", "weight", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size"))
        .otherwise(0.0).alias("rate"))


def draw(seed: int, doc_id: Column, text: Column) -> Column:
    """Uniform number in [0, 1) with 52 bits from the seed, id and text."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                      F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def planned(docs: DataFrame, steps: Steps, source: str = "source", text: str = "text",
            **options) -> DataFrame:
    """The source plan as a step table, with a broadcast hint if it is small."""
    return broadcast_if_small(steps.save(source_plan(docs, source, text, **options), "sources"))


def copies(docs: DataFrame, seed: int = 0, doc_id: str = "doc_id", source: str = "source",
           text: str = "text", **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies."""
    plan = planned(docs, Steps(docs.sparkSession, "mixing"), source, text, **options)
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("doc_source"),
                       n_words(F.col(text)).alias("size"),
                       draw(seed, F.col(doc_id), F.col(text)).alias("u"))
    joined = thin.join(plan, F.col("doc_source").eqNullSafe(F.col("source")))
    return joined.select("doc_id", "size", "source_size", "target", _copies("rate", "u").alias("copies"))


def _copies(rate: str, u: str) -> Column:
    whole = F.floor(F.col(rate))
    return (whole + (F.col(u) < F.col(rate) - whole).cast("long")).cast("long")


def mix(docs: DataFrame, seed: int = 0, doc_id: str = "doc_id", source: str = "source",
        text: str = "text", copy_column: str = "copy_no", **options) -> DataFrame:
    """The mixed corpus: every emitted copy as a row of ``docs`` with a copy
    number from 1 on, in ``copy_column``; underscores are added to that name
    while ``docs`` has such a column (in any case of letters)."""
    taken = {c.lower() for c in docs.columns}
    while copy_column.lower() in taken:
        copy_column += "_"
    plan = planned(docs, Steps(docs.sparkSession, "mixing"), source, text, **options) \
        .select(F.struct("source", "rate").alias("_plan"))
    body = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
                       draw(seed, docs[doc_id], docs[text]).alias("_u"))
    joined = body.join(plan, F.col("_doc")[source].eqNullSafe(F.col("_plan.source"))) \
        .select("_doc", "_u", F.col("_plan.rate").alias("_rate"))
    n = _copies("_rate", "_u")
    return joined.where(n > 0).select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("_no")) \
        .select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns],
                F.col("_no").alias(copy_column))
