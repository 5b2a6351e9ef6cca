"""Toxic passages by maximum-scoring segments.

Tokens are lower-cased words. A token's score is its log-odds of occurring
in a toxic text, minus a drift: shares of toxic documents are smoothed by a
chain of Dirichlet priors, from the overall share over word beginnings of
growing length to the whole word, so rare words borrow from their stems. A
token is scored by the longest of these that the model knows.

All maximal-scoring segments of a text are found in one linear scan. On clean
texts the number of segments that score at least x falls off as
``K * n * exp(-lambda * x)`` for n tokens; with K and lambda fitted there,
the best segments of a text get an extreme-value significance, and a
logistic curve fitted on held-back rows turns that into a probability.

The model is fitted on a bounded sample of labelled rows, ``MAX_ROWS`` in
expectation, chosen by a hash of the id; rows that are held out never enter
it. Its table has at most ``MAX_FEATURES`` entries of 16 bytes and is
broadcast. Every text is scored whole; scoring is row-local.

Defined cases: a null or empty text has no segment and gets the score of
one; a null id counts as the text "" for the split and has no label; with
repeated labels an id is toxic if any says so; without two classes in the
sample every score is the sample's share; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X

MAX_ROWS = 16_000
MAX_FEATURES = 1_000_000
#: Bytes of the word beginnings that back a word up; a whole word comes last.
STEMS = (3, 4, 5, 6, 8)
#: Weight of a prior, in documents, and documents that a feature needs.
PRIOR, MIN_DOCS = 8.0, 4
#: Taken from every token's log-odds, so that texts drift downwards.
DRIFT = 1.0
#: Segments from this score on enter the fit of K and lambda.
TAIL = 1.0
CUT = 0.7
SIGNIFICANT = 0.01


@dataclass
class Model:
    #: Per level (the last is the whole word): sorted hashes, log-odds.
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    k: float = 0.1
    decay: float = 1.0
    #: Intercept and slope of the probability curve.
    curve: tuple[float, float] = (0.0, 0.0)

    def token_scores(self, w: X.Words) -> np.ndarray:
        out = np.zeros(len(w.start))
        roll = X.Rolling(w.buf)
        for (hashes, odds), length in zip(self.levels, (*STEMS, None)):
            h = features(roll, w, length)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                out = np.where(hashes[at] == h, odds[at], out)
        return out - DRIFT

    def evidence(self, n: int, scores: list[float]) -> float:
        """-log of the smallest tail probability over the r best segments, for
        every r, each paying r bits for having been tried."""
        best = 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            e = self.k * n * math.exp(-self.decay * s)
            if e < r:  # otherwise r or more are as likely as not
                best = max(best, -log_tail(r, e) - r * math.log(2))
        return min(best, 60.0)

    def probability(self, evidence: float) -> float:
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, a + b * evidence))))


def log_tail(r: int, e: float) -> float:
    """Log of the probability of ``r`` or more events where ``e`` < ``r`` are
    expected (Poisson): the first term times a falling series."""
    if e <= 0.0:
        return -math.inf
    total, term, j = 1.0, 1.0, r
    while term > 1e-15 * total:
        j += 1
        term *= e / j
        total += term
    return r * math.log(e) - e - math.lgamma(r + 1) + math.log(total)


def features(roll: X.Rolling, w: X.Words, length: int | None) -> np.ndarray:
    """Hash of each word's first ``length`` bytes, or of the whole word; a
    word is marked as ended where the beginning is all of it."""
    if length is None:
        return X.mix(roll.of(w.start, w.end) + np.uint64(1))
    end = np.minimum(w.start + length, w.end)
    return roll.of(w.start, end)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, exclusive end, score) of a text.

    One pass over the positive tokens with a stack of candidates; a candidate
    is extended backwards to the nearest one with a smaller sum before it if
    that one's sum behind it is smaller too. Each candidate is merged once.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, before, after, index of nearest smaller
    for i in np.flatnonzero(scores > 0).tolist():
        start, before, after = i, float(total[i]), float(total[i + 1])
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
            j -= 1
        stack.append((start, i + 1, before, after, j))
    return [(a, z, after - before) for a, z, before, after, _ in stack]


def held_out(doc_id) -> "F.Column":
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(text, toxic, part): at most ``MAX_ROWS`` rows in expectation, ids
    with remainder 1 left out; part 3 is kept back for the curve."""
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    n = known.count()
    part = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20).cast("long"))
    chosen = known.where(part * n < F.lit(MAX_ROWS << 20)).withColumn("part", F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(4).cast("long")))
    if n <= MAX_ROWS * 64:
        chosen = F.broadcast(chosen)
    thin = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    return thin.join(chosen, F.col("id") == F.col("label_id")).select("text", "toxic", "part")


def _count(sample: DataFrame) -> DataFrame:
    """(level, h, toxic, n): documents of the sample that have a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, toxic = X.batch_bytes(b.column(0)), b.column(1).to_numpy(zero_copy_only=False) > 0
            for lo, hi in X.blocks(texts):
                w = X.Words(texts[lo:hi], X.NON_ALNUM)
                own = np.repeat(np.arange(lo, hi), w.count)
                roll = X.Rolling(w.buf)
                for level, length in enumerate((*STEMS, None)):
                    h = features(roll, w, length)
                    order = np.lexsort((own, h))
                    h, d = h[order], own[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    u, inverse = np.unique(h[new], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), level, np.int32)), pa.array(u.view(np.int64)),
                         pa.array(np.bincount(inverse, toxic[d[new]], len(u)).astype(np.int64)),
                         pa.array(np.bincount(inverse, minlength=len(u)))], ["level", "h", "toxic", "n"])

    return sample.mapInArrow(run, "level int, h long, toxic long, n long") \
        .groupBy("level", "h").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _with_parents(sample: DataFrame) -> DataFrame:
    """(level, h, parent): each feature's next shorter beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = X.batch_bytes(b.column(0))
            for lo, hi in X.blocks(texts):
                w = X.Words(texts[lo:hi], X.NON_ALNUM)
                roll = X.Rolling(w.buf)
                all_levels = [features(roll, w, length) for length in (*STEMS, None)]
                for level in range(1, len(all_levels)):
                    u, first = np.unique(all_levels[level], return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), level, np.int32)), pa.array(u.view(np.int64)),
                         pa.array(all_levels[level - 1][first].view(np.int64))], ["level", "h", "parent"])

    return sample.mapInArrow(run, "level int, h long, parent long").dropDuplicates(["level", "h"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    sample = labelled_sample(docs, labels, doc_id, text).cache()
    try:
        n, toxic = sample.select(F.count("*"), F.sum((F.col("toxic") > 0).cast("long"))).first()
        if not n or not 0 < toxic < n:
            share = (toxic or 0) / n if n else 0.0
            return Model(curve=(math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0))
        learn = sample.where("part < 3")
        table = _count(learn).where(F.col("n") >= MIN_DOCS) \
            .join(_with_parents(learn), ["level", "h"], "left") \
            .orderBy(F.desc("n"), "level", "h").limit(MAX_FEATURES).toPandas()
        model = _log_odds(table, toxic / n)
        spread = segment_scores(sample.select("text", F.lit(True).alias("x"), "toxic", "part"), model, ("toxic", "part"))
        _calibrate(model, spread.toPandas())
        return model
    finally:
        sample.unpersist()


def _log_odds(table, share: float) -> Model:
    """Smoothed shares level by level, then their distance from the overall one."""
    logit = lambda p: np.log(p) - np.log1p(-p)
    model, below = Model(), (np.empty(0, np.uint64), np.empty(0))
    for level in range(len(STEMS) + 1):
        t = table[table["level"] == level]
        h = t["h"].to_numpy(np.int64).view(np.uint64)
        prior = np.full(len(t), share)
        if len(below[0]):
            parent = t["parent"].fillna(0).to_numpy(np.int64).view(np.uint64)
            at = np.minimum(np.searchsorted(below[0], parent), len(below[0]) - 1)
            prior = np.where(below[0][at] == parent, below[1][at], prior)
        p = (t["toxic"].to_numpy(float) + PRIOR * prior) / (t["n"].to_numpy(float) + PRIOR)
        order = np.argsort(h)
        below = (h[order], p[order])
        model.levels.append((h[order], logit(np.clip(p[order], 1e-6, 1 - 1e-6)) - logit(share)))
    return model


def _calibrate(model: Model, docs) -> None:
    """K and lambda from the clean texts' segments, the curve from part 3."""
    clean = docs[docs["toxic"] <= 0]
    high = np.concatenate([np.asarray(s, float) for s in clean["scores"]] + [np.empty(0)])
    high = high[high >= TAIL]
    model.decay = 1.0 / max(1e-3, float((high - TAIL).mean())) if len(high) else 1.0
    model.k = (len(high) + 1) / (float(clean["n"].sum()) + 1) * math.exp(model.decay * TAIL)
    back = docs[docs["part"] == 3]
    back = back if 0 < (back["toxic"] > 0).sum() < len(back) else docs
    x = np.array([model.evidence(int(n), list(s)) for n, s in zip(back["n"], back["scores"])])
    y = (back["toxic"] > 0).to_numpy(float)
    a, b = 0.0, 0.0
    for _ in range(50):  # Newton steps with a weak pull to zero
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * x).sum() - 1e-3 * b])
        v = p * (1 - p)
        h = np.array([[v.sum() + 1e-3, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
    model.curve = (a, max(0.0, b))


def segment_scores(rows: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns, n (tokens), spans (start, end) and scores of the
    segments of ``rows.text`` that score at least ``TAIL``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema[c] for c in keep] + T.StructType.fromDDL(
        "n long, starts array<long>, ends array<long>, scores array<double>, probability double, limit double").fields)
    thin = rows.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            texts, out = X.batch_bytes(b.column(len(keep))), []
            for lo, hi in X.blocks(texts):
                w = X.Words(texts[lo:hi], X.NON_ALNUM)
                s = model.token_scores(w)
                for d in range(hi - lo):
                    n = int(w.count[d])
                    found = [x for x in segments(s[w.first[d]:w.first[d + 1]]) if x[2] >= TAIL]
                    starts, ends, scores = [list(c) for c in zip(*found)] or [[], [], []]
                    limit = math.log(max(model.k * n / SIGNIFICANT, 1e-9)) / model.decay
                    out.append((n, starts, ends, scores, model.probability(model.evidence(n, scores)), limit))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                b.columns[:len(keep)] + [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], schema.names)

    return thin.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, passages (segments
    expected less than once in 100 clean texts of this length: start and
    exclusive end in words, score)."""
    model = model or fit(docs, labels, doc_id, text)
    thin = docs.select(docs[doc_id].alias("doc_id"), held_out(docs[doc_id]).alias("held_out"), docs[text].alias("text"))
    found = segment_scores(thin, model, ("doc_id", "held_out"))
    passages = F.filter(F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"),
                                     F.col("scores").alias("score")), lambda p: p["score"] >= F.col("limit"))
    return found.select("doc_id", "held_out", F.col("probability").alias("score"),
                        (F.col("probability") >= CUT).cast("int").alias("predicted"), passages.alias("passages"))
