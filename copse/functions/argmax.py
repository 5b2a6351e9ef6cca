"""Majority with a total order: highest count wins, ties go to the
smallest label. The reference breaks ties by hash-map iteration order;
a total order makes results independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_label(label: str | Column, count: str | Column) -> Column:
    """Aggregate: the label with the largest count, smallest label on ties."""
    label = F.col(label) if isinstance(label, str) else label
    count = F.col(count) if isinstance(count, str) else count
    return F.max_by(label, F.struct(count, -label))
