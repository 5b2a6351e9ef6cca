"""Column expressions shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once (a lambda body that
    names an expression computes it anew for each element)."""
    return F.get(F.transform(F.array(value), body), 0)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def upto(n: Column) -> Column:
    """Array 0 .. n-1, empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda acc, x: acc + x)
