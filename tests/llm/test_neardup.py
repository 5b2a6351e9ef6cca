import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from copse.llm import neardup
from copse.llm.components import components
from copse.llm.scratch import Steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(k, max(1, len(w)))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, k, percent):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(d)
    name = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(d, len(sets[i]), name[root(i)]) for i, (d, _) in enumerate(docs)], len(ids)


def fixture():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for g in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([5, 30, 80, 200]))]
        for _ in range(rnd.choice([1, 2, 4, 12])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            docs.append((1000 - len(docs), (" " if g % 2 else "\n").join(w)))
    # A chain: neighbours are similar, the ends are not.
    w = [rnd.choice(vocab) for _ in range(120)]
    for i in range(12):
        docs.append((2000 + i, " ".join(w)))
        w = w[:10 * i] + [rnd.choice(vocab)] + w[10 * i + 1:]
    docs += [(3000, None), (3001, ""), (3002, " \n"), (3003, "One two"), (3004, "one TWO"), (3005, "one two"),
             (3006, "x " * 5000), (3007, "x " * 900), (None, docs[0][1]), (None, "no id at all here"),
             (None, "no id at all here"), (5, docs[3][1]), (5, "another text under the same id")]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("rounds", [(1, 2, None), (1, None)])
def test_partners_held_back_change_nothing(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    monkeypatch.setattr(neardup, "FIRST", 0)
    docs = fixture()
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == sorted(brute(docs, 4, 80)[0], key=str)


@pytest.mark.parametrize("k", [4, 5])
def test_equals_all_pairs(spark, k):
    docs = fixture()
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, n int, sig string").repartition(4)
    got = neardup.near_duplicates(d, k)
    rows = got.collect()
    want, n_components = brute(docs, k, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == sorted(want, key=str)
    for r in rows:
        if r.component_id is not None:
            assert r.kept == (r.doc_id == r.component_id)
    assert sum(r.first for r in rows) == n_components


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_dedupe_keeps_one_row_of_each_component(spark):
    docs = fixture() + [(2000, "twice the same row"), (2000, "twice the same row")]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, first int")
    out = neardup.dedupe(d, 4)
    assert out.columns == d.columns
    # The rows 2000 are three: the chain's first and a component of two.
    assert out.count() == brute(docs, 4, 80)[1]


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 299), (7, 7)]
    rnd.shuffle(edges)
    got = components(spark.createDataFrame(edges, "u long, w long"), Steps(spark, "test"))
    want = {v: 0 for v in range(61)} | {v: 100 for v in range(100, 150)} | {299: 299, 300: 299}
    assert {r.v: r.comp for r in got.collect()} == want and got.count() == len(want)


def test_pairs_that_share_a_key_are_never_dropped_by_distance(spark):
    """Signatures that agree in four values of one chunk only; equal sketches."""
    rnd = np.random.default_rng(4)
    sig = rnd.integers(0, 1 << 15, (2, neardup.VALUES)).astype("<u2")
    sig[1] = sig[0] + 1
    sig[1, 1:5] = sig[0, 1:5]
    assert neardup._first_key((sig[:1] == sig[1:]), 0).all()
    s = np.unique(rnd.integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2))
    rows = [(v, len(s), bytearray(sig[v].tobytes()), bytearray(neardup.sketch(s)), v) for v in range(2)]
    classes = spark.createDataFrame(rows, "v long, n long, sig binary, sketch binary, r long")
    pairs = spark.createDataFrame([(0, 1)], "a long, b long")
    assert neardup.close(pairs, classes, 80).count() == 1
    keys = neardup.index_keys(classes).groupBy("key").count().where("count > 1").select("key")
    members = neardup.index_keys(classes).join(keys, "key").selectExpr("key", "no", "v", "v as comp")
    assert {tuple(sorted(r)) for r in neardup.across(members, classes, 80).select("a", "b").collect()} == {(0, 1)}


def test_release_keeps_step_tables(spark):
    steps = Steps(spark, "test")
    one = steps.save(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "one")
    steps.release()
    two = steps.save(one.groupBy("count").agg(F.sum("k").alias("k")), "two")
    steps.release()
    assert sorted(map(tuple, two.collect())) == [(14, 20), (15, 1)]
    assert one.count() == 7


def test_across_names_the_keys_that_held_partners_back(spark):
    """Five equal classes under one key: with one partner each, all but one
    give out one and the key is named; with all, none is."""
    s = np.arange(1, 200, dtype=np.uint64) << np.uint64(55)
    rows = [(v, len(s), bytearray(neardup.signature(s)), bytearray(neardup.sketch(s))) for v in range(5)]
    classes = spark.createDataFrame(rows, "v long, n long, sig binary, sketch binary")
    members = spark.createDataFrame([(42, 0, v, v) for v in range(5)], "key long, no int, v long, comp long")
    some = neardup.across(members, classes, 80, 1).collect()
    assert len(some) < 10 and {r.key for r in some if r.more} == {42}
    every = neardup.across(members, classes, 80).collect()
    assert len({tuple(sorted((r.a, r.b))) for r in every}) == 10 and not any(r.more for r in every)


def test_keys_of_the_same_classes_are_kept_once(spark):
    """Two equal signatures meet under every key; a third shares one chunk of
    the second's. Members grow with the sets of classes, not with the keys."""
    rnd = np.random.default_rng(6)
    sig = rnd.integers(0, 1 << 15, (3, neardup.VALUES)).astype("<u2")
    sig[1] = sig[0]
    sig[2, -neardup.WIDTH:] = sig[0, -neardup.WIDTH:]
    s = np.unique(rnd.integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2))
    rows = [(v, len(s), bytearray(sig[v].tobytes()), bytearray(neardup.sketch(s)), v) for v in range(3)]
    classes = spark.createDataFrame(rows, "v long, n long, sig binary, sketch binary, r long")
    keys = neardup.index_keys(classes)
    buckets = neardup.shared_keys(keys)
    members = keys.join(buckets, "key").select("key", "no", "v", F.col("v").alias("comp"))
    assert sorted(r["count"] for r in members.groupBy("key").count().collect()) == [2, 3]
    got = neardup.across(members, classes, 80).select("a", "b").collect()
    assert sorted(tuple(sorted(r)) for r in got) == [(0, 1), (0, 2), (1, 2)]


def test_index_is_no_larger_than_the_texts_need():
    """At most 32 keys a class, and a pair at 0.8 is missed less than once in 100,000."""
    n = len(neardup._KEEP) * neardup.CHUNKS
    meets = sum(math.comb(neardup.WIDTH, e) * 0.8 ** (neardup.WIDTH - e) * 0.2 ** e for e in range(neardup.ERRORS + 1))
    assert n <= 32 and (1 - meets) ** neardup.CHUNKS < 1e-5


def test_joins_with_bucketed_steps_shuffle_the_other_side_only(spark):
    steps = Steps(spark, "test")
    plain = steps.save(spark.range(1000).select(F.col("id").alias("v"), F.repeat(F.lit("x"), 50).alias("s")), "plain")
    kept = steps.bucketed(plain, "v", "kept")
    few = spark.range(0, 1000, 7).select(F.col("id").alias("a"))
    joined = kept.hint("merge").join(few, F.col("v") == F.col("a"))
    assert joined.count() == 143 and sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))
    plan = joined._jdf.queryExecution().sparkPlan().toString(), joined._jdf.queryExecution().executedPlan().toString()
    assert plan[1].count("Exchange hashpartitioning(a") == 1 and "Exchange hashpartitioning(v" not in plan[1]
