"""Seeded pseudo-random draws as native column expressions.

``DataFrame.sample`` and ``rand(seed)`` depend on how rows are laid out
in partitions, so a re-partitioned or recomputed input draws different
rows. Here a draw is a pure function of (seed, model, key): the first 52
bits of md5 of the text ``"seed|model|key"`` divided by 2**52, so a draw
times a row count reaches every row up to about 10**15 of them.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO52 = 4503599627370496.0
HEX_DIGITS = 13


def _key_text(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hash52(key) -> Column:
    """The first 52 bits of md5 of the key's text, as a bigint."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, HEX_DIGITS), 16, 10).cast("bigint")


def uniform(seed: int, model, key) -> Column:
    """U[0,1) draw from md5 of ``seed|model|key``."""
    return hash52(_key_text(seed, model, key)).cast("double") / F.lit(TWO52)


def draw(seed: int, model, key) -> float:
    """``uniform`` of one model and key, on the driver."""
    return int(hashlib.md5(f"{seed}|{model}|{key}".encode()).hexdigest()[:HEX_DIGITS], 16) / TWO52


def hash_range(h: Column, n_ranges: int) -> Column:
    """Range in [0, n_ranges) of a 52-bit hash; increases with the hash, so
    ranges follow the hash order whatever their number."""
    return F.floor(h.cast("double") * F.lit(float(n_ranges)) / F.lit(TWO52)).cast("bigint")


def poisson_cuts(rate: float, tail: float = 1e-12) -> list[float]:
    """Cumulative Poisson(rate) probabilities P(N <= k), k = 0, 1, ...

    Terms come from their logarithms, so no rate underflows. Stops beyond
    the mean once a term is below ``tail`` times a hundredth; a draw above
    the last cut gets weight len(cuts).
    """
    if rate <= 0:
        return []
    cuts, acc, k = [], 0.0, 0
    while True:
        term = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        acc += term
        cuts.append(acc)
        if k > rate and (1.0 - acc < tail or term < tail / 100):
            return cuts
        k += 1


def poisson_weight(u: Column, rate: float) -> Column:
    """Inverse-CDF Poisson(rate) count for a uniform draw ``u``: the number
    of cuts at or below it."""
    cuts = poisson_cuts(rate)
    if not cuts:
        return F.lit(0).cast("int")
    if len(cuts) > 64:
        table = F.from_json(F.lit(str(cuts)), "array<double>")
        return F.size(F.filter(table, lambda c: c <= u)).cast("int")
    expr = F.when(u < F.lit(cuts[0]), F.lit(0))
    for k, c in enumerate(cuts[1:], start=1):
        expr = expr.when(u < F.lit(c), F.lit(k))
    return expr.otherwise(F.lit(len(cuts))).cast("int")
