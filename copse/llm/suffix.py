"""Exact substring dedup by a distributed difference-cover algorithm.

The task needs to know which ``length``-byte prefixes of suffixes occur
twice, so suffixes are ordered by that prefix only, and by fingerprint
instead of by letter: equal prefixes are adjacent in any consistent order.

* A perfect difference cover D modulo v samples the positions whose
  remainder is in D. For any two positions there is a shift below v that
  moves both to sampled ones. So if two strings of ``length`` bytes agree,
  sampled strings of ``length - v + 1`` bytes agree at the same place in
  both.
* The sampled strings get names (fingerprints built up by rolling, in
  place of the recursive renaming of triples), and the names are sorted.
* Names that occur twice decide which of the remaining suffixes matter:
  those that start less than v before such a sampled string. These get
  names of the full prefix, which are sorted, and equal neighbours are the
  repeated prefixes.

Both sorts run on packed blocks of names: a chunk of a few megabytes of
text sends each name once to the name's range (names that repeat inside the
chunk are marked), and gets one bit for each name back. No range holds more
than one copy of a name for each chunk, however often a passage occurs.
Texts are written once, bucketed by chunk, and all passes read them in
place. Equal texts are found first and stand for one another.

Names of the first sort have 48 bits beyond those that choose the range; a
clash there only adds candidates. Names of the second sort have 64 bits of
a second fingerprint beyond those that choose the range.

Defined cases: a null text is empty; texts shorter than ``length`` have no
repeats; repeated rows repeat each other; null ids are passed through; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X
from copse.llm.scratch import Steps
from copse.llm.store import COPY, PREFIX, SAMPLE, SIDE, keep_texts, per_chunk

LENGTH = 200
#: Names that a range holds, on average, at most.
RANGE_NAMES = 2_000_000

#: Perfect difference sets by modulus.
COVERS = {
    3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52), 73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest cover that leaves at least 5/8 of the length to names."""
    v = max((v for v in COVERS if 8 * (length - v + 1) >= 5 * length), default=3)
    return v, COVERS[v]


class Chunk:
    """The texts of a chunk and their names, in the order of the texts."""

    def __init__(self, texts: list[bytes], length: int):
        self.texts, self.length = texts, length
        self.v, cover = cover_for(length)
        self.window = length - self.v + 1
        self.sampled = np.zeros(max(map(len, texts), default=0) + self.v, bool)
        for d in cover:
            self.sampled[d::self.v] = True

    def _blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo, hi in X.blocks(self.texts):
            n = np.fromiter(map(len, self.texts[lo:hi]), np.int64, hi - lo)
            yield np.frombuffer(b"".join(self.texts[lo:hi]), np.uint8), np.concatenate(([0], np.cumsum(n)))

    def _masks(self, at: np.ndarray, window: int, pattern: np.ndarray | None) -> np.ndarray:
        """Positions of a block where a string of ``window`` bytes starts."""
        out = np.zeros(at[-1], bool)
        for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
            if z - a >= self.length:
                n = z - a - window + 1
                out[a:a + n] = True if pattern is None else pattern[:n]
        return out

    def sample_names(self) -> "Names":
        h = [np.empty(0, np.uint64)]
        for buf, at in self._blocks():
            pos = np.flatnonzero(self._masks(at, self.window, self.sampled))
            h.append(X.Rolling(buf).of(pos, pos + self.window))
        return Names(np.concatenate(h))

    def candidates(self, repeated: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per block: bytes, text offsets, starts less than v before a
        repeated sampled string. ``repeated``: one flag for each sample."""
        done = 0
        for buf, at in self._blocks():
            pos = np.flatnonzero(self._masks(at, self.window, self.sampled))
            pos, done = pos[repeated[done:done + len(pos)]], done + len(pos)
            own = at[np.searchsorted(at, pos, "right") - 1]
            near = X.cover(len(buf), np.maximum(own, pos - self.v + 1), pos + 1)
            yield buf, at, np.flatnonzero(near & self._masks(at, self.length, None))

    def prefix_names(self, repeated: np.ndarray) -> "Names":
        h, g = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for buf, _, pos in self.candidates(repeated):
            if len(pos):
                h.append(X.Rolling(buf).of(pos, pos + self.length))
                g.append(X.Rolling(buf, 1).of(pos, pos + self.length))
        return Names(np.concatenate(h), np.concatenate(g))

    def repeats(self, repeated: np.ndarray, twice: np.ndarray) -> Iterator[np.ndarray]:
        """Per text, its starts of repeated strings of ``length`` bytes."""
        done = 0
        for _, at, pos in self.candidates(repeated):
            pos, done = pos[twice[done:done + len(pos)]], done + len(pos)
            for a, lo, hi in zip(at[:-1].tolist(), *np.searchsorted(pos, (at[:-1], at[1:])).tolist()):
                yield pos[lo:hi] - a


class Names:
    """Distinct names of a chunk in order; those of a range are adjacent."""

    def __init__(self, h: np.ndarray, second: np.ndarray | None = None):
        self.h, first, self.inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        self.many = n > 1
        self.width = 6 if second is None else 8
        self.rest = self.h if second is None else second[first]

    def parts(self, ranges: int) -> Iterator[tuple[int, np.ndarray, bytes, bytes]]:
        """(range, which names are in it only once, those, the others)."""
        part = ((self.h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        cut = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
        packed = self.rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :self.width]
        for r in np.flatnonzero(np.diff(cut)).tolist():
            here = slice(cut[r], cut[r + 1])
            many = self.many[here]
            yield r, here.start + np.flatnonzero(~many), packed[here][~many].tobytes(), packed[here][many].tobytes()

    def flags(self, ranges: int, bits: dict[int, bytes]) -> np.ndarray:
        """One flag for each position: does its name occur twice anywhere?"""
        twice = self.many.copy()
        for r, once, _, _ in self.parts(ranges):
            twice[once] = np.unpackbits(np.frombuffer(bits[r], np.uint8), count=len(once)).view(bool)
        return twice[self.inverse]


def _unpack(blobs: list[bytes], width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _compare(names: DataFrame, level: int, width: int) -> DataFrame:
    """Sorts each range's names; a bit for each name that a chunk sent once:
    is there an equal neighbour?"""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        once, many = t["once"].to_pylist(), t["many"].to_pylist()
        size = np.array([len(x) // width for x in once])
        values = _unpack(once + many, width)
        order = np.argsort(values)
        ordered = values[order]
        step = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(values) else np.empty(0, bool)
        start = np.flatnonzero(step)
        twice = np.diff(np.append(start, len(values))) > 1
        twice |= np.logical_or.reduceat(order >= size.sum(), start) if len(start) else False
        found = np.empty(len(values), bool)
        found[order] = np.repeat(twice, np.diff(np.append(start, len(values))))
        cut = np.concatenate(([0], np.cumsum(size)))
        bits = [np.packbits(found[a:z]).tobytes() for a, z in zip(cut[:-1].tolist(), cut[1:].tolist())]
        return pa.table({"chunk": t["chunk"], "kind": pa.array([level] * len(bits), pa.int32()),
                         "k": t["range"], "data": pa.array(bits, pa.binary())})

    return names.groupBy("range").applyInArrow(run, SIDE)


def _copies(store: DataFrame, length: int) -> DataFrame:
    """Texts of at least ``length`` bytes that other rows have too; ``data``
    is empty for the one that stands for them."""
    thin = store.where(F.octet_length("text") >= length).select("chunk", "i", "md5")
    equal = thin.groupBy(F.col("md5").alias("m")).agg(F.count("*").alias("n"), F.min(F.struct("chunk", "i")).alias("rep")) \
        .where("n > 1")
    return thin.join(equal, F.col("md5") == F.col("m")).select(
        "chunk", F.lit(COPY).alias("kind"), F.col("i").alias("k"),
        F.when(F.struct("chunk", "i") == F.col("rep"), F.lit(b"")).otherwise(F.lit(b"c")).alias("data"))


def repeated_substrings(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id",
                        text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, spans (maximal runs of bytes that some
    string of ``length`` bytes covers which also starts elsewhere; start and
    exclusive end), kept (the other bytes, concatenated)."""
    spark = docs.sparkSession
    steps = Steps(spark, "suffix")
    store = keep_texts(docs, steps, doc_id, text)
    total = store.select(F.sum(F.octet_length("text"))).first()[0] or 0
    v, cover = cover_for(length)
    ranges = {SAMPLE: max(1, -(-total * len(cover) // v // RANGE_NAMES)), PREFIX: max(1, -(-total // (2 * RANGE_NAMES)))}
    copies = steps.save(_copies(store, length), "copies")

    def chunk(rows, skip):
        texts = X.batch_bytes(rows["text"])
        return texts, Chunk([b"" if skip.get(i) else t for i, t in enumerate(texts)], length)

    def send(names, chunk_id, n):
        parts = [(r, once, many) for r, _, once, many in names.parts(n)]
        return pa.table({"chunk": pa.array([chunk_id] * len(parts), pa.int64()),
                         "range": pa.array([p[0] for p in parts], pa.int32()),
                         "once": pa.array([p[1] for p in parts], pa.binary()),
                         "many": pa.array([p[2] for p in parts], pa.binary())})

    def id_of(rows):
        return rows["chunk"][0].as_py() if rows.num_rows else 0

    def sample(rows, skip, _):
        return send(chunk(rows, skip)[1].sample_names(), id_of(rows), ranges[SAMPLE])

    def prefix(rows, skip, bits):
        c = chunk(rows, skip)[1]
        return send(c.prefix_names(c.sample_names().flags(ranges[SAMPLE], bits[SAMPLE])), id_of(rows), ranges[PREFIX])

    out = T.StructType([store.schema["doc_id"], *T.StructType.fromDDL(
        "n_bytes long, spans array<struct<start:long,end:long>>, kept binary").fields])

    def finish(rows, skip, bits):
        texts, c = chunk(rows, skip)
        repeated = c.sample_names().flags(ranges[SAMPLE], bits[SAMPLE])
        twice = c.prefix_names(repeated).flags(ranges[PREFIX], bits[PREFIX])
        spans, kept = [], []
        for i, (t, start) in enumerate(zip(texts, c.repeats(repeated, twice))):
            if i in skip:
                s, e = np.array([0]), np.array([len(t)])
            else:
                s, e = X.runs(X.cover(len(t), start, start + length))
            spans.append([{"start": a, "end": z} for a, z in zip(s.tolist(), e.tolist())])
            edges = [0, *np.stack((s, e), axis=1).ravel().tolist(), len(t)]
            kept.append(b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2])))
        return pa.table({"doc_id": rows["doc_id"], "n_bytes": pa.array(map(len, texts), pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         "kept": pa.array(kept, pa.binary())})

    names = "chunk long, range int, once binary, many binary"
    side = copies
    for level, width, fn in ((SAMPLE, 6, sample), (PREFIX, 8, prefix)):
        found = _compare(per_chunk(store, side, names, fn), level, width)
        side = side.unionByName(steps.save(found, "bits"))
    return per_chunk(store, side, out, finish)
