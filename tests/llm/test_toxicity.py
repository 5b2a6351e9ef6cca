import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from copse.llm import toxicity

SCHEMA = "doc_id long, text string, score double, toxic int"


def all_segments(scores):
    """Maximal segments by their definition: take the best, recurse beside it."""
    best = (0.0, 0, 0)
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best[0]:
                best = (total, i, j + 1)
    if best[0] <= 0:
        return []
    s, i, j = best
    return [*all_segments(scores[:i]), (i, j, s), *((a + j, z + j, t) for a, z, t in all_segments(scores[j:]))]


@pytest.mark.parametrize("seed", range(60))
def test_linear_scan_finds_all_maximal_segments(seed):
    rnd = np.random.default_rng(seed)
    scores = rnd.normal(-0.3, 2, rnd.integers(0, 40)).round(3)
    want, got = all_segments(scores.tolist()), toxicity.segments(scores)
    assert [w[:2] for w in want] == [g[:2] for g in got]
    assert np.allclose([w[2] for w in want], [g[2] for g in got])


def corpus(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    bad, rows, labels = ["zqslur", "zqvile", "zqscum"], [], []
    for i in range(1500):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(5, 120))]
        toxic = int(rnd.random() < 0.15)
        for _ in range(3 * toxic):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad) + rnd.choice(["", "s", "ish", "!!"]))
        rows.append((i, " ".join(w), 0.1, 0))
        labels.append((i, 1, toxic))
    rows += [(None, "zqslur zqvile", 0.1, 0), (2000, None, 0.1, 0), (2001, "", 0.1, 0), (2002, "zqslurs " * 4000, 0.1, 0),
             (2003, "clean " + " ".join(vocab * 20), 0.1, 0), (3, rows[3][1], 0.1, 0)]
    labels += [(3, 1, None), (None, 1, 1), (9999, 0, 1)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus(spark)
    return toxicity.score(docs, labels).collect(), {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}


def test_held_out_accuracy(scored):
    rows, truth = scored
    out = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert len(out) > 400
    right = [(r.predicted, truth[r.doc_id]) for r in out]
    assert sum(p == t for p, t in right) >= 0.97 * len(out)
    assert sum(p and t for p, t in right) >= 0.9 * sum(t for _, t in right)


def test_split_is_by_crc32_of_the_id(scored):
    import zlib
    for r in scored[0]:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_odd_texts(scored):
    by = {r.doc_id: r for r in scored[0]}
    assert by[2000].score == by[2001].score and not by[2000].predicted and not by[2000].passages
    assert by[2002].predicted and by[2002].passages and by[None].predicted
    assert not by[2003].predicted


def test_rows_held_out_do_not_change_the_model(spark, scored):
    docs, labels = corpus(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score(docs, turned).collect()
    key = lambda rows: sorted((str(r.doc_id), r.score) for r in rows)
    assert key(again) == key(scored[0])


def test_empty_tables_and_one_class(spark):
    docs, labels = corpus(spark)
    assert toxicity.score(docs.where("false"), labels).count() == 0
    few = docs.where("doc_id < 20")
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert not any(r.predicted for r in toxicity.score(few, none).collect())


def test_evidence_counts_every_segment():
    """Long texts with many medium passages; figures from exact sums."""
    model = toxicity.Model(k=0.09, decay=1.0)
    assert model.evidence(5000, [4.2] * 40) == pytest.approx(12.8, abs=0.05)
    assert model.evidence(5000, [4.0] * 60) == pytest.approx(28.6, abs=0.05)
    assert model.evidence(5000, [4.2] * 8) == 0.0 and model.evidence(0, []) == 0.0


@pytest.mark.parametrize("r,e", [(1, 1e-6), (1, 0.9), (5, 0.04), (8, 3.0), (40, 6.7), (300, 250.0)])
def test_log_tail_equals_the_sum(r, e):
    from fractions import Fraction
    x, above = Fraction(e), Fraction(0)
    for j in range(r, r + 400):
        above += x ** (j - r) * math.factorial(r) / math.factorial(j)
    want = r * math.log(e) - e - math.lgamma(r + 1) + math.log(above)
    assert toxicity.log_tail(r, e) == pytest.approx(want, rel=1e-9)
