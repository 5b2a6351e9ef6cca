"""Quality rules: hashed n-gram log-likelihood ratios.

Words and word pairs, lower-cased, fall into ``BUCKETS`` hashed buckets. Two
multinomials over the buckets are counted, one over the texts that the
labels call good, one over the whole corpus. A document's score is the mean
over its n-grams of log p_trusted - log p_raw; it is kept if it passes the
base rules and its score is at least ``THRESHOLD``.

Built-in functions only. The two counts are grouped by bucket, combined
before the shuffle, so what is shuffled or reaches the driver is bounded by
the buckets, not by the corpus; they come back as one array constant and
the score is row-local. The trusted ids are broadcast while they are
measured to be small; beyond that, the join that finds their texts is the
only shuffle of texts.

Defined cases: a null text has no words and fails the base rules; labels
without a document, repeated labels and null ids do no harm (a null id is
never trusted); with no trusted text at all every score is 0 (nothing to compare with); an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copse.llm.expressions import let, total, upto, words
from copse.llm.scratch import Steps, broadcast_if_small

BUCKETS = 1 << 14
#: Mean log ratio, in nats for each n-gram, that a kept document reaches.
THRESHOLD = -0.075
#: Occurrences added to every bucket, on both sides at the trusted texts'
#: scale, so that n-grams too rare to have been trusted weigh little.
PSEUDO = 20.0
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def buckets(text: Column) -> Column:
    """Bucket numbers of the words and word pairs of a text."""
    place = lambda *w: F.pmod(F.xxhash64(*w), F.lit(BUCKETS).cast("long")).cast("int")
    return let(words(F.lower(text)), lambda w: F.concat(
        F.transform(w, lambda x: place(x)),
        F.transform(upto(F.size(w) - 1), lambda i: place(F.get(w, i), F.get(w, i + 1)))))


def _counts(docs: DataFrame, text: str) -> dict[int, int]:
    grams = docs.select(F.explode(buckets(F.col(text))).alias("bucket"))
    return {r.bucket: r["count"] for r in grams.groupBy("bucket").count().collect()}


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[float]:
    """log p_trusted - log p_raw by bucket. The raw counts are brought to the
    trusted texts' number of n-grams, then both get ``PSEUDO`` more."""
    good = Steps(docs.sparkSession, "quality").save(
        labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("good_id")).distinct(), "good")
    thin = docs.select(docs[doc_id].alias("id"), docs[text].alias("body"))
    trusted = _counts(thin.join(broadcast_if_small(good), F.col("id") == F.col("good_id"), "left_semi"), "body")
    raw = _counts(thin, "body")
    scale = sum(trusted.values()) / max(1, sum(raw.values()))
    return [math.log((trusted.get(b, 0) + PSEUDO) / (scale * raw.get(b, 0) + PSEUDO)) for b in range(BUCKETS)]


def score(text: Column, ratios: list[float]) -> Column:
    """Mean log ratio over the n-grams; null for a text without words."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    return let(buckets(text), lambda b: total(F.transform(b, lambda i: F.get(table, i)), F.lit(0.0))
               / F.nullif(F.size(b), F.lit(0)))


def n_repeat_words(w: Column) -> Column:
    """Words inside a window of ``WINDOW`` words found twice or more."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    windows = let(hashes, lambda h: F.transform(
        upto(F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = let(ordered, lambda s: F.filter(F.transform(s, lambda x, i: F.when(
            (F.get(s, i - 1).h == x.h) | (F.get(s, i + 1).h == x.h), x.i)), lambda x: x.isNotNull()))
        return let(F.sort_array(again), lambda p: total(F.transform(p, lambda x, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0)))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score."""
    ratios = log_ratios(docs, labels, doc_id, text)
    thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return thin.select("doc_id", *base("text"), score(F.col("text"), ratios).alias("score")) \
        .select("*", _failed().alias("base_failed")) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "score")


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def base(text: str) -> list[Column]:
    """The base columns of a text column."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                              n_repeat_words(w).cast("long").alias("again")))
    long = lambda c, name: c.cast("long").alias(name)
    return [F.inline(F.array(counts)).alias("n_words", "n_repeat_words"),
            long(F.length(F.translate(t, " \t\n\x0b\f\r", "")), "word_chars"),
            long(F.length(t) - F.length(F.translate(t, SYMBOLS, "")), "n_symbols"),
            long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), "n_dup_lines")]


def keep(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """The kept documents with all their columns."""
    ratios = log_ratios(docs, labels, doc_id, text)
    body = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), docs[text].alias("_text"))
    judged = body.select("_doc", *base("_text"), score(F.col("_text"), ratios).alias("_score")) \
        .where(~_failed() & (F.col("_score") >= threshold))
    return judged.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
