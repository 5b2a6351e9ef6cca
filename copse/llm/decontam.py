"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter
item is one window). For every window length L that the items have, both
sides are winnowed alike: of each ``L - k + 1`` consecutive k-gram hashes
the minimum is kept, so any shared span of L words keeps a common k-gram at
the same place in it, on both sides. Document fingerprints found among the
benchmark's are extended: the windows of the item around the k-gram are
compared with the document's words at the same offset.

The benchmark is the query set. It goes to the tasks in blocks of at most
``BLOCK_WORDS`` words (measured, not assumed); all documents are run
against each block, and where there is more than one, the hit words of a
document are merged over the blocks by its row number in a step table.
Nothing is joined document to document, and no shuffle carries text.

Word equality is equality of 64-bit word hashes; a window counts only if
all of its words agree, so a false hit needs that many collisions at once.

Defined cases: a null or empty text has no words and is not contaminated;
an item without words is never found; items with the same id count once
for a document; a null item id is written as the empty string; repeated
documents give repeated rows; empty tables give an empty or a clean result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X
from copse.llm.scratch import Steps

WINDOW = 13
GRAM = 5
#: Words of one block of the benchmark (8 bytes each, twice).
BLOCK_WORDS = 1_000_000
RESULT = "n_words long, n_hit long, contaminated boolean, items array<string>, spans array<long>"


class Index:
    """A block of benchmark items: words, window starts and fingerprints."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = ["" if i is None else str(i) for i in ids]
        w = X.Words(texts, X.NON_ALNUM)
        self.words, self.first = w.hashes(), w.first
        self.by_length = {}
        lengths = np.minimum(w.count, WINDOW)
        for length in np.unique(lengths[lengths > 0]).tolist():
            k = min(GRAM, length)
            gram, item, at = [], [], []
            for i in np.flatnonzero(lengths == length).tolist():
                own = self.words[self.first[i]:self.first[i + 1]]
                h = X.shingles(own, k)
                pos = winnow(h, length - k + 1)
                gram.append(h[pos])
                item.append(np.full(len(pos), i))
                at.append(pos)
            gram, item, at = map(np.concatenate, (gram, item, at))
            order = np.argsort(gram, kind="stable")
            self.by_length[length] = (k, gram[order], item[order], at[order])

    def hits(self, words: np.ndarray, same_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) of every document position where a window starts.

        ``words`` are the word hashes of a block of documents, ``same_doc``
        the end of the own document for each position.
        """
        found = []
        for length, (k, gram, item, at) in self.by_length.items():
            if len(words) < length:
                continue
            h = X.shingles(words, k)
            pos = winnow(h, length - k + 1)
            lo = np.searchsorted(gram, h[pos])
            pos, lo = pos[(hit := lo < len(gram))], lo[hit]
            keep = gram[lo] == h[pos]
            pos, lo = pos[keep], lo[keep]
            n = np.searchsorted(gram, h[pos], "right") - lo
            # One row for each (document k-gram, benchmark k-gram), a piece at a time.
            for a in _pieces(n):
                p, m = np.repeat(pos[a], n[a]), np.repeat(lo[a], n[a])
                m = m + np.arange(len(m)) - np.repeat(np.cumsum(n[a]) - n[a], n[a])
                found += self._extend(words, same_doc, p, item[m], at[m], length, k)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        both = np.unique(np.concatenate(found), axis=0)
        return both[:, 0], both[:, 1]

    def _extend(self, words, same_doc, pos, item, at, length, k):
        """Windows around matched k-grams whose words all agree."""
        for shift in range(length - k + 1):
            start, own = pos - shift, at - shift
            base = self.first[item] + own
            ok = (own >= 0) & (start >= 0) & (base + length <= self.first[item + 1])
            ok[ok] &= start[ok] + length <= same_doc[start[ok]]
            start, base, which = start[ok], base[ok], item[ok]
            for j in range(length):
                if not len(start):
                    break
                same = words[start + j] == self.words[base + j]
                start, base, which = start[same], base[same], which[same]
            if len(start):
                yield np.stack((start, which), axis=1)

    def length(self, item: np.ndarray) -> np.ndarray:
        return np.minimum(self.first[item + 1] - self.first[item], WINDOW)


def _pieces(n: np.ndarray, limit: int = 1 << 18) -> Iterator[slice]:
    """Slices of the matches whose pairs number about ``limit`` each."""
    if len(n):
        cuts = np.searchsorted(np.cumsum(n), np.arange(limit, n.sum() + limit, limit), "right")
        lo = 0
        for hi in np.unique(np.maximum(cuts, 1)).tolist() + [len(n)]:
            if hi > lo:
                yield slice(lo, hi)
                lo = hi


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the minimum of some w consecutive ones."""
    if len(h) < w:
        return np.empty(0, np.int64)
    low = X.sliding_min(h, w)
    pad = np.zeros(w - 1, np.uint64)
    best = X.sliding_max(np.concatenate((pad, low, pad)), w)
    return np.flatnonzero(best == h)


def benchmark_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[bytes]]]:
    """The benchmark, cut into blocks of bounded size, streamed through the
    driver: it holds a block and a partition of the items at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item_id), F.encode(F.col(text), "UTF-8")).toLocalIterator():
        t = bytes(row[1] or b"")
        if ids and size + len(t) > 2 * BLOCK_WORDS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(t)
        size += len(t)
    yield ids, texts


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, contaminated, items (distinct
    ids in string order), spans (start and exclusive end of each run of hit
    words, flat)."""
    spark = docs.sparkSession
    parts = benchmark_blocks(items, item_id, item_text)
    thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    first, second = next(parts), next(parts, None)
    if second is not None:
        steps = Steps(spark, "decontam")
        thin = steps.save(thin.withColumn("row", F.monotonically_increasing_id()), "rows")
        found = None
        for part in chain((first, second), parts):  # broadcast, and so on disk, before the next is read
            one = _scan(thin, part, "row")
            found = one if found is None else found.unionByName(one)
        merged = found.groupBy("row").applyInPandas(
            _merge, "row long, " + RESULT)
        return thin.drop("text").join(merged, "row").drop("row")
    return _scan(thin, first, "doc_id")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc_id"),
                        docs[text].alias("text"))
    found = decontaminate(whole, items, "doc_id", "text", item_id, item_text)
    return found.where(~F.col("contaminated")).select(
        *[F.col("doc_id").getField(c).alias(c) for c in docs.columns])


def _merge(pdf):
    import pandas as pd
    n = int(pdf["n_words"].iloc[0])
    spans = np.concatenate([np.asarray(s, np.int64) for s in pdf["spans"]])
    s, e = X.runs(X.cover(n, spans[::2], spans[1::2]))
    hit = int((e - s).sum())
    return pd.DataFrame([{"row": pdf["row"].iloc[0], "n_words": n, "n_hit": hit,
                          "contaminated": hit > 0 and 20 * hit >= n,
                          "items": sorted({i for x in pdf["items"] for i in x}),
                          "spans": np.stack((s, e), axis=1).ravel()}])


def _scan(thin: DataFrame, part: tuple[list, list[bytes]], key: str) -> DataFrame:
    shared = thin.sparkSession.sparkContext.broadcast(part)
    schema = T.StructType([thin.schema[key], *T.StructType.fromDDL(RESULT).fields])
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for b in batches:
            texts = X.batch_bytes(b.column(b.schema.get_field_index("text")))
            out = [row for lo, hi in X.blocks(texts) for row in _block(index, texts[lo:hi])]
            cols = [b.column(b.schema.get_field_index(key))] + [
                pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return thin.mapInArrow(run, schema)


def _block(index: Index, texts: list[bytes]) -> Iterator[tuple]:
    w = X.Words(texts, X.NON_ALNUM)
    words = w.hashes()
    same_doc = np.repeat(w.first[1:], w.count)
    pos, item = index.hits(words, same_doc)
    end = pos + index.length(item)
    doc = np.searchsorted(w.first, pos, "right") - 1
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in range(len(texts)):
        a, z = cut[d], cut[d + 1]
        n, base = int(w.count[d]), w.first[d]
        if a == z:
            yield n, 0, False, [], []
            continue
        s, e = X.runs(X.cover(n, pos[a:z] - base, end[a:z] - base))
        hit = int((e - s).sum())
        ids = sorted({index.ids[i] for i in np.unique(item[a:z]).tolist()})
        yield n, hit, 20 * hit >= n, ids, np.stack((s, e), axis=1).ravel().tolist()
