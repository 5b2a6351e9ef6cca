"""Periodic runs by enumerating maximal pairs over LCP-interval trees.

A run is a stretch of consecutive words with smallest period q, of at least
``least`` words and ``times`` periods, that no neighbour extends. Words q
apart are equal in it, so its first and last ``length - q`` words are two
occurrences, at distance q, of one string that neither the words before them
nor those after them extend: a maximal pair. The other way round, a maximal
pair of l words at distance d is a stretch of l + d words of period d that
nothing extends. So the maximal pairs with l + d >= max(least, times * d) are
exactly the runs (and their multiples: a run of period q appears again at
2 q with the same ends; the least period is kept). No pair is extended.

Within a task, a block of texts at a time:

1. Words become integers. Texts without a repeated ``depth``-gram (the
   shortest string of a pair) have no runs; the others' suffixes are sorted
   by prefix doubling in numpy, where only suffixes that are still tied are
   sorted again, and the ranks of the rounds give the LCPs.
2. The LCP-interval tree is walked bottom-up. An interval has its positions in
   lists by left word, and in one list; the smaller child goes into the
   larger. Strings at distance d <= l / (times - 1) overlap in more than half,
   so of positions that near each other all but the first have one left word.
   A new position therefore pairs, to its right, with the class list of
   its neighbour's left word, cut at that distance, and, to its left, with
   the leftmost position within that distance at most: every search ends in a
   pair or after a binary search.

Texts are whole; all arrays are proportional to one block (or to one text that
is longer). Everything is row-local: no shuffle, nothing is collected.

Defined cases: a null or blank text has no words, no runs and an empty
collapsed text; a text is its own row, so repeated rows and null or repeated
ids are passed through; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X
from copse.llm.expressions import let, words

LEAST, TIMES = 6, 4
BLOCK_BYTES = 4 << 20


def shortest_pair(least: int, times: int) -> int:
    """The fewest words l of a pair: least of max(least, times * q) - q."""
    q = least // times
    return min([(times - 1) * (q + 1)] + [least - q] * (q > 0))


class Intern(dict):
    """Numbers for words, from 0 on."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before it."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return new


class Suffixes:
    """Suffixes of texts, sorted within each text, with their LCPs. ``sa`` are
    positions; ``lcp[i]`` belongs to ``sa[i - 1]`` and ``sa[i]`` (0 across texts)."""

    def __init__(self, ids: np.ndarray, end: np.ndarray):
        n = len(ids)
        at = np.arange(n, dtype=np.int64)
        order = np.lexsort((ids, end))
        new = _dense(order, end, ids)
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, at, 0))
        levels, h = [rank.astype(np.int32)], 1
        while True:
            size = np.bincount(rank, minlength=n)
            tied = at[size[rank] > 1]
            if not len(tied):
                break
            ahead = tied + h
            second = np.where(ahead < end[tied], rank[np.minimum(ahead, n - 1)], -1)
            own = rank[tied]
            order = np.lexsort((second, own))
            group, new = own[order], _dense(order, own, second)
            first = _dense(order, own)
            place = np.arange(len(order))
            inside = place - np.maximum.accumulate(np.where(first, place, 0))
            start = np.maximum.accumulate(np.where(new, place, 0))
            rank = rank.copy()
            rank[tied[order]] = group + inside[start]
            levels.append(rank.astype(np.int32))
            h *= 2
        self.sa = np.empty(n, np.int64)
        self.sa[rank] = at
        a, b = self.sa[:-1].copy(), self.sa[1:].copy()
        low = np.zeros(max(n - 1, 0), np.int64)
        for j in range(len(levels) - 1, -1, -1):
            inside = (a < end[self.sa[:-1]]) & (b < end[self.sa[1:]])
            level = levels[j]
            same = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
            step = same.astype(np.int64) << j
            a, b, low = a + step, b + step, low + step
        self.lcp = np.concatenate(([0], low))


class Interval:
    """Positions of a string: all in order, and by left word."""

    __slots__ = ("order", "lists")

    def __init__(self, position: int, left: int):
        self.order, self.lists = [position], {left: [position]}

    def take(self, other: "Interval") -> None:
        _merge(self.order, other.order)
        for word, positions in other.lists.items():
            own = self.lists.get(word)
            if own is None:
                self.lists[word] = positions
            else:
                _merge(own, positions)


def _merge(into: list[int], other: list[int]) -> None:
    if 16 * len(other) > len(into):
        into.extend(other)
        into.sort()
    else:
        for x in other:
            insort(into, x)


def _pairs(small: Interval, large: Interval, l: int, left, times: int, least: int, out: list) -> None:
    """Maximal pairs of l words between two children of an interval."""
    reach = l // (times - 1)
    order = large.order
    for x in small.order:
        word = left[x]
        k = bisect_left(order, x)
        if k < len(order) and order[k] - x <= reach and left[order[k]] != word:
            near = large.lists[left[order[k]]]
            lo, hi = bisect_left(near, x), bisect_right(near, x + reach)
            out.extend((x, l + y - x, y - x) for y in near[lo:hi] if l + y - x >= least)
        if k and x - order[k - 1] <= reach:
            y = order[bisect_left(order, x - reach, 0, k)]
            if left[y] != word and l + x - y >= least:
                out.append((y, l + x - y, x - y))


def maximal_pairs(sa: list[int], lcp: list[int], left, times: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal pairs that satisfy the
    constraints, in a stretch of suffixes; ``lcp[i]`` as in ``Suffixes``, the
    first being no part of it. Multiples of a period are included."""
    out, stack = [], []
    for i, position in enumerate(sa):
        low = lcp[i + 1] if i + 1 < len(sa) else 0
        now = Interval(position, left[position])
        while stack and stack[-1][0] >= low:
            l, other = stack[-1]
            small, large = (now, other) if len(now.order) <= len(other.order) else (other, now)
            _pairs(small, large, l, left, times, least, out)
            large.take(small)
            now = large
            stack.pop()
            if l == low:
                break
        if low:
            stack.append((low, now))
    return out


def block_runs(texts: list[list[bytes]], least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text (a list of words), by start
    and period."""
    found: list[dict] = [{} for _ in texts]
    depth = shortest_pair(least, times)
    number = Intern()
    ids = np.concatenate([np.empty(0, np.int64), *[np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]])
    count = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.repeat(np.arange(len(texts)), count)
    end = np.repeat(np.cumsum(count), count)
    # Texts with a repeated gram (a clash of hashes only adds texts).
    fits = np.flatnonzero(np.arange(len(ids)) + depth <= end)
    grams = X.shingles(X.mix(ids.astype(np.uint64) + np.uint64(1)), depth)
    own = X.mix(grams[fits] ^ X.mix(text[fits].astype(np.uint64))) if len(fits) else np.empty(0, np.uint64)
    ordered = np.sort(own)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    where = np.searchsorted(again, own)
    repeated = again[np.minimum(where, len(again) - 1)] == own if len(again) else np.zeros(len(own), bool)
    some = np.zeros(len(texts), bool)
    some[text[fits[repeated]]] = True
    ids, text = ids[some[text]], text[some[text]]
    if not len(ids):
        return [[] for _ in texts]
    count = np.where(some, count, 0)
    base = np.cumsum(count) - count
    suffixes = Suffixes(ids, np.repeat(base + count, count))
    left = np.concatenate(([-1], ids[:-1]))
    left[base[count > 0]] = -1
    for a, z in _stretches(suffixes, depth, times):
        sa = suffixes.sa[a:z]
        t = text[sa[0]]
        here = found[t]
        own_left = dict(zip(sa.tolist(), left[sa].tolist()))
        for start, length, period in maximal_pairs(sa.tolist(), suffixes.lcp[a:z].tolist(), own_left, times, least):
            key = (start - int(base[t]), length)
            if period < here.get(key, length):
                here[key] = period
    return [sorted(((s, n, q) for (s, n), q in f.items()), key=lambda r: (r[0], r[2])) for f in found]


def _stretches(suffixes: Suffixes, depth: int, times: int) -> Iterator[tuple[int, int]]:
    """Ranges of suffixes with LCPs of ``depth`` or more in which two positions
    are near enough for a pair."""
    a, z = X.runs(suffixes.lcp >= depth)
    if not len(a):
        return
    a = a - 1
    member = np.repeat(np.arange(len(a)), z - a)
    inner = np.arange(len(member)) + np.repeat(a - (np.cumsum(z - a) - (z - a)), z - a)
    position = suffixes.sa[inner]
    order = np.lexsort((position, member))
    step = np.diff(position[order])
    step[np.diff(member) != 0] = np.iinfo(np.int64).max
    first = np.cumsum(z - a) - (z - a)
    near = np.minimum.reduceat(np.append(step, np.iinfo(np.int64).max), first)
    longest = np.maximum.reduceat(np.where(np.isin(inner, a), 0, suffixes.lcp[inner]), first)
    keep = near <= longest // (times - 1)
    yield from zip(a[keep].tolist(), z[keep].tolist())


def collapse(words_of: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that lie in no run after its first period, joined by a space."""
    if found:
        start, length, period = (np.array(c) for c in zip(*found))
        gone = X.cover(len(words_of), start + period, start + length)
        words_of = [w for w, out in zip(words_of, gone.tolist()) if not out]
    return b" ".join(words_of)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, doc_id: str = "doc_id",
                  text: str | Column = "text") -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period, by start and
    period), collapsed (the text with each run cut to its first period)."""
    if times < 3 or least < 1:
        raise ValueError("times must be 3 or more and least 1 or more")
    thin = docs.select(docs[doc_id].alias("doc_id"), (docs[text] if isinstance(text, str) else text).alias("text"))
    schema = T.StructType([thin.schema["doc_id"], *T.StructType.fromDDL(
        "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string").fields])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = X.batch_bytes(b.column(1))
            for lo, hi in X.blocks(raw, BLOCK_BYTES):
                texts = [t.split() for t in raw[lo:hi]]
                found = block_runs(texts, least, times)
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(map(len, texts), pa.int64()), pa.array(runs, kind),
                     pa.array([collapse(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())],
                    schema.names)

    return thin.mapInArrow(run, schema)


def repeat_tail(doc_id: Column, text: Column) -> Column:
    """Every tenth text, by h = crc32(doc_id), with its words from a on replaced by
    repetitions of the first p of them: g = h div 10, a = g mod n, p = 1 +
    (n - a) div (3 + g mod 8). Other texts, and those of null ids, stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w)
        return let(F.struct(w.alias("w"), (g % n).alias("a")), lambda s: let(
            F.struct(s["w"].alias("w"), s["a"].alias("a"), (F.lit(1) + F.floor((n - s["a"]) / (g % 8 + 3))).alias("p")),
            lambda s: F.array_join(F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(
                F.get(s["w"], (s["a"] + (i - s["a"]) % s["p"]).cast("int")))), " ")))

    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), let(words(text), tail)).otherwise(text)
