"""Vector distances over ``ARRAY<DOUBLE>`` columns, kept in native
higher-order functions (``zip_with`` + ``aggregate``) so they stay inside
whole-stage codegen; no Python UDF touches a row.

Both folds run left to right over the components, which is also the
order the DuckDB oracle sums in; results are still rounded before any
ranking because engines may differ in the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _checked(a: Column, b: Column, value: Column) -> Column:
    # zip_with pads the shorter side with NULL; unequal length is an error
    # rather than the silent truncation of Scala's zip.
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit("vectors of unequal length")).cast("double"))


def l1_distance(a: Column, b: Column) -> Column:
    """Sum of absolute differences (the reference's "approximate Euclidean")."""
    diffs = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return _checked(a, b, F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, d: acc + d))


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return _checked(a, b, F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, d: acc + d)))


def distance(metric: str, a: Column, b: Column) -> Column:
    if metric not in ("l1", "l2"):
        raise ValueError(f"unknown metric {metric!r}; use 'l1' or 'l2'")
    return l1_distance(a, b) if metric == "l1" else l2_distance(a, b)


def projection(metric: str, v: Column, dim: int) -> Column:
    """A 1-D projection that never exceeds the distance between two points.

    For L1, |sum(x) - sum(y)| <= sum|x - y|. For L2 the unit vector
    (1, ..., 1)/sqrt(d) gives |p.x - p.y| <= ||x - y||. The exact k-NN
    search uses this bound to restrict candidates to a band.
    """
    total = F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    if metric == "l1":
        return total
    if metric == "l2":
        return total / F.lit(float(dim) ** 0.5)
    raise ValueError(f"unknown metric {metric!r}")


def distance_sql(metric: str, a: str, b: str) -> str:
    """DuckDB text of :func:`distance` (used by the oracle)."""
    if metric == "l1":
        return (f"list_reduce(list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2])),"
                f" lambda acc, d: acc + d, 0.0::DOUBLE)")
    if metric == "l2":
        return (f"sqrt(list_reduce(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])),"
                f" lambda acc, d: acc + d, 0.0::DOUBLE))")
    raise ValueError(metric)
