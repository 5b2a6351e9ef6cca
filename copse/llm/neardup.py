"""MinHash near-dedup by a multi-index Hamming join.

A document's set (distinct k-word shingles) gets a signature of ``VALUES``
min-hashes of 16 bits. Signatures are cut into ``CHUNKS`` chunks of
``WIDTH`` values. By the pigeonhole principle, two signatures that differ in
at most ``CHUNKS * (ERRORS + 1) - 1`` values differ in at most ``ERRORS``
values within some chunk; each chunk is indexed once for every choice of
``ERRORS`` values left out, so all such pairs meet under some key. A pair
at similarity 0.8 is missed with probability 6.3e-6 (all seven chunks must
have two or more differing values of four); pairs that meet are not tested
for the distance of their signatures again. Of keys with the same classes,
the first stands for all.

Pairs within a key are not listed. Documents with equal sets are one class
from the start. Classes are kept in buckets, so pairs are shuffled to their
sketches, never the sketches of all. Each class is first compared with the smallest class of its
keys, for the ``FIRST`` smallest of these; what such links connect needs no
more comparisons. For every key whose classes are then still in several
components, signatures are compared across components, inside the tasks, in
blocks: the classes outside a key's largest component against all of it. A
class gives out its likeliest partners only, few at first; they are
confirmed, what they connect drops out, and the next round takes up the keys
that held partners back and gives out more of what is still apart. A round that
held nothing back is the last, so every pair has been confirmed, refused, or
connected otherwise. Pairs that meet under
several keys are taken up under the first.

A sketch (the smallest shingle hash of each of 1,024 bins, 8 bits) tests a
pair before its texts are fetched; a pair at similarity 0.8 fails by six
standard deviations or not at all. Candidates are confirmed on full sets
computed from whole texts.

Hot groups: equal sets and keys are aggregated before the shuffle; the
comparisons under a popular key, and those of a popular class, are dealt
into groups of bounded size that stream through a task in sorted order.

Defined cases: a null, empty or blank text has an empty set, is linked
with nothing and is its own component; rows with equal ids are separate
documents; a null id takes part by its text and never names a component
that has other ids; component_id is null only where all ids are null, and
then one row of the component is kept. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X
from copse.llm.components import contract, labels
from copse.llm.scratch import Steps, shuffle_parts
from copse.llm.store import keep_texts, key, pick, with_texts

CHUNKS, WIDTH, ERRORS = 7, 4, 1
VALUES = CHUNKS * WIDTH
GROUP = 64
#: Comparisons of a class before those across components.
FIRST = 4
#: Classes of one block of comparisons under a key: outside, and in all.
BLOCK_LEFT, BLOCK_RIGHT = 1024, 4096
#: Partners that a class gives out in a block, by round; all in the last.
ROUNDS = (4, 64, None)
BINS = 1024
#: Standard deviations that a sketch may fall short of the similarity.
SLACK = 6.0

_rng = np.random.default_rng(20240301)
_FACTORS = _rng.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEEP = [list(c) for c in combinations(range(WIDTH), WIDTH - ERRORS)]


def sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = X.Words(texts, X.BLANKS)
    words = w.hashes()
    out = []
    for d in range(len(texts)):
        own = words[w.first[d]:w.first[d + 1]]
        out.append(np.unique(X.shingles(own, min(k, max(1, len(own))))))
    return out


def signature(s: np.ndarray) -> bytes:
    low = np.array([(s * f).min() for f in _FACTORS]) if len(s) < 4096 else \
        np.array([min((s[i:i + 65536] * f).min() for i in range(0, len(s), 65536)) for f in _FACTORS])
    return (X.mix(low) >> np.uint64(48)).astype("<u2").tobytes()


def sketch(s: np.ndarray) -> bytes:
    """For each of ``BINS`` ranges of hash values, 8 bits of the smallest
    shingle hash in it (1 to 255; 0 for an empty range)."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    first = np.searchsorted(s, edges)
    has = np.diff(np.append(first, len(s))) > 0
    out = np.zeros(BINS, np.uint8)
    out[has] = X.mix(s[first[has]]) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def plausible(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of sketches can belong to sets similar enough; ``sizes``
    is the sum of the two sets' sizes. A sketch sees a share of the union
    (all of it, for sets much smaller than the sketch); only what it does
    not see varies."""
    used, same = _shared(a, b)
    p = percent / 100
    unseen = np.clip(1 - used * (1 + p) / sizes, 0.02, 1)
    return same >= p * used - SLACK * np.sqrt(used * p * (1 - p) * unseen) - 2


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins that a pair of sketches uses, and those in which they agree."""
    return ((a | b) > 0).sum(axis=-1), ((a == b) & (a > 0)).sum(axis=-1)


def describe(store: DataFrame, k: int) -> DataFrame:
    """doc_id, r (the text's key), h (hash of the text), n, digest of the
    set, signature, sketch."""
    thin = store.select("doc_id", key().alias("r"), F.xxhash64("text").alias("h"), "text")
    schema = T.StructType([thin.schema["doc_id"], *T.StructType.fromDDL(
        "r long, h long, n long, digest binary, sig binary, sketch binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = X.batch_bytes(b.column(3))
            n, digest, sig, sk = [], [], [], []
            for lo, hi in X.blocks(texts):
                for s in sets(texts[lo:hi], k):
                    n.append(len(s))
                    digest.append(hashlib.md5(s.tobytes()).digest())
                    sig.append(signature(s) if len(s) else None)
                    sk.append(sketch(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(sk, pa.binary())], schema.names)

    return thin.mapInArrow(run, schema)


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, no, v): every chunk of a signature under every choice of values;
    ``no`` counts the combinations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                sig = _matrix(part.column(1)).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
                keys = np.empty((len(sig), CHUNKS, len(_KEEP)), np.uint64)
                for j, keep in enumerate(_KEEP):
                    packed = sum(sig[:, :, i] << np.uint64(16 * n) for n, i in enumerate(keep))
                    keys[:, :, j] = X.mix(X.mix(packed) + np.arange(CHUNKS, dtype=np.uint64) * np.uint64(64)
                                          + np.uint64(j + 1))
                flat = keys.reshape(len(sig), -1).view(np.int64)
                no = np.tile(np.arange(flat.shape[1], dtype=np.int32), len(sig))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat.ravel()), pa.array(no), pa.array(np.repeat(part.column(0).to_numpy(), flat.shape[1]))],
                    ["key", "no", "v"])

    return classes.select("v", "sig").mapInArrow(run, "key long, no int, v long")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, pivot): the keys of more than one class, and the smallest of these.
    Of keys with the same classes only that with the least ``no``: every pair
    under the others meets under it, and ``_first_key`` never leaves it out."""
    found = keys.groupBy("key").agg(F.min("v").alias("pivot"), F.count("*").alias("size"), F.min("no").alias("no"),
                                    F.bit_xor(F.xxhash64("v")).alias("all")).where("size > 1")
    return found.groupBy("size", "pivot", "all").agg(F.min(F.struct("no", "key")).alias("first")) \
        .select("first.key", "pivot")


def _matrix(column, kind: str = "<u2", width: int = VALUES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _sketches(column) -> np.ndarray:
    return _matrix(column, "u1", BINS)


def close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, a_r, b_r): the pairs whose sketches and sizes allow a link, with
    the keys of their texts."""
    side = lambda s: classes.select(*[F.col(c).alias(f"{s}{c}") for c in ("v", "n", "sketch", "r")])
    both = pairs.join(side("a_"), F.col("a") == F.col("a_v")).join(side("b_"), F.col("b") == F.col("b_v")) \
        .where((F.col("a_n") * 100 >= F.col("b_n") * percent) & (F.col("b_n") * 100 >= F.col("a_n") * percent))
    names = ["a", "b", "a_r", "b_r"]
    full = both.select(*names, "a_sketch", "b_sketch", (F.col("a_n") + F.col("b_n")).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                c = b.slice(lo, 4096)
                like = plausible(_sketches(c.column(4)), _sketches(c.column(5)), c.column(6).to_numpy(), percent)
                yield pa.RecordBatch.from_arrays(c.columns[:4], names).filter(pa.array(like))

    return full.mapInArrow(run, "a long, b long, a_r long, b_r long")


def confirm(near: DataFrame, store: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, w): the pairs whose full sets are similar enough.

    Each b's partners are dealt into groups; a group's rows are b's text and
    then the partners' texts, streamed through a task in that order.
    """
    degree = near.groupBy("b").agg(F.count("*").alias("n"))
    near = near.join(degree, "b").withColumn(
        "salt", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / GROUP)).cast("long"))
    role = lambda s, no: near.select(F.col(f"{s}_r").alias("r"), "b", "salt", F.lit(no).alias("side"),
                                     F.col(s).alias("v"))
    roles = role("a", 1).unionByName(role("b", 0).distinct())
    rows = with_texts(store, roles, "r", ["b", "salt", "side", "v"]) \
        .repartition(shuffle_parts(store.sparkSession), "b", "salt").sortWithinPartitions("b", "salt", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, None
        for b in batches:
            texts = X.batch_bytes(b.column(4))
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            side, v = b.column(2).to_pylist(), b.column(3).to_pylist()
            u, w = [], []
            for lo, hi in X.blocks(texts):
                for i, s in zip(range(lo, hi), sets(texts[lo:hi], k)):
                    if side[i] == 0:
                        group, first = keys[i], s
                    elif group == keys[i]:
                        both = len(np.intersect1d(first, s, assume_unique=True))
                        if 100 * both >= percent * (len(first) + len(s) - both):
                            u.append(v[i])
                            w.append(keys[i][0])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(w, pa.int64())], ["u", "w"])

    return rows.mapInArrow(run, "u long, w long").distinct()


def across(members: DataFrame, classes: DataFrame, percent: int, most: int | None = None) -> DataFrame:
    """(a, b, more, key): classes of a key in different components whose sketches
    allow a link; for each a in a block, the ``most`` likeliest, ``more`` telling
    that the key held some back. ``members``: key, no, v, comp."""
    mixed = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    rest = members.join(mixed, "key")
    size = rest.groupBy("key", "comp").count().groupBy("key").agg(
        F.max(F.struct("count", "comp")).alias("m"), F.sum("count").alias("n"))
    size = size.select("key", F.col("m.comp").alias("main"),
                       F.ceil((F.col("n") - F.col("m.count")) / BLOCK_LEFT).cast("int").alias("ps"),
                       F.ceil(F.col("n") / BLOCK_RIGHT).cast("int").alias("qs")).where("ps > 0")
    rows = rest.join(size, "key").join(classes.select("v", F.col("n").alias("size_"), "sig", "sketch"), "v") \
        .withColumn("in", F.col("comp") == F.col("main"))
    own = lambda c: F.pmod(F.xxhash64("v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["v", "comp", "in", "no", "sig", "sketch", "size_"]
    left = rows.where("not in").select("key", own("ps").alias("p"), every("qs").alias("q"), F.lit(0).alias("side"), *columns)
    right = rows.select("key", every("ps").alias("p"), own("qs").alias("q"), F.lit(1).alias("side"), *columns)
    dealt = left.unionByName(right).repartition(shuffle_parts(members.sparkSession), "key", "p", "q") \
        .sortWithinPartitions("key", "p", "q", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lefts = None, []
        for b in batches:
            ids = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            side, v, comp, no = (b.column(i).to_numpy() for i in (3, 4, 5, 7))
            inside = b.column(6).to_numpy(zero_copy_only=False)
            sig, sk, n = _matrix(b.column(8)), _sketches(b.column(9)), b.column(10).to_numpy()
            new = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1) | (side[1:] != side[:-1])) + 1
            found = [np.empty((0, 4), np.int64)]
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                if group != tuple(ids[lo]):
                    group, lefts = tuple(ids[lo]), []
                if side[lo] == 0:
                    lefts += [(v[i], comp[i], sig[i], sk[i], n[i]) for i in range(lo, hi)]
                    continue
                for a, ca, sa, ka, na in lefts:
                    at = lo + np.flatnonzero((comp[lo:hi] != ca) & (inside[lo:hi] | (v[lo:hi] > a)))
                    at = at[(100 * n[at] >= percent * na) & (100 * na >= percent * n[at])]
                    at = at[_first_key(sa == sig[at], int(no[lo]))]
                    at = at[plausible(ka, sk[at], n[at] + na, percent)]
                    more = most is not None and len(at) > most
                    if more:
                        used, same = _shared(ka, sk[at])
                        at = at[np.lexsort((v[at], -same / used))[:most]]
                    found.append(np.stack((np.full(len(at), a), v[at], np.full(len(at), more),
                                           np.full(len(at), ids[lo, 0])), axis=1))
            a, b, more, key = np.concatenate(found).T.copy()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(more.astype(bool)), pa.array(key)],
                                             ["a", "b", "more", "key"])

    return dealt.mapInArrow(run, "a long, b long, more boolean, key long")


def _first_key(same: np.ndarray, no: int) -> np.ndarray:
    """Rows (equal values of two signatures) without a common key before
    ``no``."""
    chunks = same.reshape(len(same), CHUNKS, WIDTH)
    keys = np.stack([chunks[:, :, keep].all(axis=2) for keep in _KEEP], axis=2).reshape(len(same), CHUNKS * len(_KEEP))
    return ~keys[:, :no].any(axis=1)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, h (hash of the
    text), first (true for one row of each component)."""
    steps = Steps(docs.sparkSession, "neardup")
    return _groups(keep_texts(docs, steps, doc_id, text), steps, k, percent).drop("r")


def _groups(store: DataFrame, steps: Steps, k: int, percent: int) -> DataFrame:
    rows = steps.save(describe(store, k), "rows")
    order = lambda *c: F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *c)
    named = steps.save(
        rows.where("n > 0").groupBy("digest").agg(F.min(order("r")).alias("rep"),
                                                  F.max("n").alias("n"), F.max("sig").alias("sig"),
                                                  F.max("sketch").alias("sketch"))
        .select("digest", "n", "sig", "sketch", "rep", "rep.r").withColumn("v", F.monotonically_increasing_id()),
        "classes")
    classes = steps.bucketed(named, "v", "classes")
    steps.drop(named)
    steps.release()
    keys = index_keys(classes)
    buckets = steps.save(shared_keys(keys), "buckets")
    members = steps.save(keys.join(buckets, "key").select("key", "no", "v", "pivot"), "members")
    steps.drop(buckets)
    steps.release()
    pairs = members.where("v != pivot").groupBy(F.col("v").alias("a")).agg(F.collect_set("pivot").alias("bs")) \
        .select("a", F.explode(F.slice(F.array_sort("bs"), 1, FIRST)).alias("b"))
    near = steps.save(close(pairs, classes, percent), "near")
    links = steps.save(confirm(near, store, k, percent), "links")
    star = contract(links, steps)
    steps.release()
    tried, open_ = None, members
    for most in ROUNDS:
        named = labels(star)
        named = named.unionByName(named.select(F.col("comp").alias("v"), "comp").distinct())
        apart = open_.join(named, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
        pairs = steps.save(across(apart, classes, percent, most), "pairs")
        steps.release()
        new = pairs.select("a", "b") if tried is None else pairs.select("a", "b").join(tried, ["a", "b"], "left_anti")
        near = steps.save(close(new, classes, percent), "near")
        links = steps.save(confirm(near, store, k, percent), "links")
        if not links.isEmpty():
            star = contract(star.unionByName(links), steps)
        steps.release()
        held = pairs.where("more").select("key").distinct()
        if most is None or held.isEmpty():
            break
        open_ = members.join(held, "key", "left_semi")
        tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
    steps.drop(members)
    return _result(rows, classes, labels(star), order)


def _result(rows: DataFrame, classes: DataFrame, label: DataFrame, order) -> DataFrame:
    named = classes.join(label, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    best = named.groupBy("comp").agg(F.min("rep").alias("best"))
    named = named.join(best, "comp").select(F.col("digest").alias("d"), "best")
    own = order("r")
    out = rows.join(named, (rows.digest == F.col("d")) & (rows.n > 0), "left") \
        .withColumn("best", F.coalesce("best", own))
    first = F.col("r") == F.col("best.r")
    kept: Column = F.when(F.col("best.doc_id").isNull(), first) \
        .otherwise(F.col("doc_id").eqNullSafe(F.col("best.doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"),
                      kept.alias("kept"), "h", first.alias("first"), "r")


def dedupe(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One document of each component, with all columns of ``docs``; only row
    keys are shuffled to the rows."""
    steps = Steps(docs.sparkSession, "dedupe")
    store = keep_texts(docs, steps, doc_id, text, whole=True)
    return pick(store, _groups(store, steps, k, percent).where("first"), "r", docs, text)
