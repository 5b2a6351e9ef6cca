"""Connected components by alternating star contraction.

Each round rewires every edge towards the smallest vertex its larger
(then smaller) end knows. A round is two grouped minima (combined before
their shuffle, so a vertex with a third of all edges is no hot group) and
a join per star; its result is a step table. Nothing is collected; the
driver sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.llm.scratch import Steps


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u move to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("w").alias("u"), F.col("u").alias("w")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("w")).alias("m"))
    return both.join(low, "u").where("w > u").select(F.col("w").alias("u"), F.col("m").alias("w"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u, move to the smallest of them."""
    down = edges.select(F.greatest("u", "w").alias("u"), F.least("u", "w").alias("w")).where("u > w")
    low = down.groupBy("u").agg(F.min("w").alias("m"))
    moved = down.join(low, "u").where("w > m").select(F.col("w").alias("u"), F.col("m").alias("w"))
    return moved.unionByName(low.select("u", F.col("m").alias("w")))


def contract(edges: DataFrame, steps: Steps, rounds: int | None = None) -> DataFrame:
    """Edges (u, w: long, not null) rewired for ``rounds`` rounds, or until
    every vertex but the smallest of its component points at that one."""
    now = steps.save(edges.select("u", "w").where("u != w"), "edges")
    seen, done = None, 0
    while rounds is None or done < rounds:
        now = steps.save(_small_star(_large_star(now)).distinct(), "star")
        state = now.agg(F.count("*"), F.sum(F.hash("u", "w").cast("long"))).first()
        if state == seen or state[0] == 0:
            break
        seen, done = state, done + 1
    return now


def labels(contracted: DataFrame) -> DataFrame:
    """(v, comp) for each vertex of contracted edges that is not the
    smallest of its component (of those contracted so far)."""
    return contracted.groupBy(F.col("u").alias("v")).agg(F.min("w").alias("comp"))


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(v, comp) for every vertex of ``edges``, comp being the smallest
    vertex that v reaches, itself included."""
    found = labels(contract(edges, steps))
    return found.unionByName(found.select(F.col("comp").alias("v"), "comp").distinct())
