"""Broadcast only behind a size check.

Model tables (tree splits, naive-Bayes counts, bucket offsets) are small
by construction, but their size still grows with models x nodes x
features x bins. ``checked_broadcast`` counts the rows of such a table
(the table is an aggregate, so the count is cheap) and hints a broadcast
only under the limits of rows and bytes; above them the frame is returned
unhinted and the join falls back to a shuffle join, where AQE's skew
handling applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 256 << 20


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("copse.broadcast.maxRows", None)
    return int(conf) if conf else DEFAULT_MAX_ROWS


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether the rows, counted now, and their size as text stay within the
    limits (a row may carry an array that grows with the models)."""
    limit = broadcast_limit(df) if max_rows is None else max_rows
    n, size = df.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return n <= limit and (size or 0) <= DEFAULT_MAX_BYTES


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def bounded_broadcast(df: DataFrame, bound: int, max_rows: int | None = None) -> DataFrame:
    """Broadcast when an analytic row bound (e.g. models x tree nodes) is under
    the limit; otherwise fall back to the counted check."""
    limit = broadcast_limit(df) if max_rows is None else max_rows
    if bound <= limit:
        return F.broadcast(df)
    return checked_broadcast(df, limit)
