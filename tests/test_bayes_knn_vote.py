import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from copse.operators import bayes as NB
from copse.operators import evaluate as EV
from copse.operators import knn as K
from copse.operators import vote as V
from copse.sources.tables import embedding_points
from tests.conftest import SF001


def test_vote_tie_smallest(spark):
    preds = spark.createDataFrame([(m, 1, p) for m, p in enumerate([3, 1, 3, 1])],
                                  "model_id int, row_id bigint, pred bigint")
    r = V.majority(preds).collect()[0]
    assert (r.pred, r.votes) == (1, 2)


def test_accuracy_counts_null_as_wrong(spark):
    j = spark.createDataFrame([(1, 1, 1), (2, None, 0), (3, 2, 1)], "row_id bigint, pred bigint, label bigint")
    r = EV.accuracy(j).collect()[0]
    assert (r.n_total, r.n_correct) == (3, 1) and abs(r.accuracy_pct - 100 / 3) < 1e-9


def _nb_bag(spark):
    rows = [(0, i, 1, lab, [float(a), float(b)]) for i, (lab, a, b) in
            enumerate([(0, 1, 1), (0, 1, 2), (1, 2, 2), (1, 2, 3), (1, 2, 2)])]
    return spark.createDataFrame(rows, "model_id int, row_id bigint, w int, label bigint, features array<double>")


def test_nb_unseen_value_finite_and_laplace_formula(spark):
    model = NB.fit(_nb_bag(spark))
    pts = spark.createDataFrame([(100, [9.0, 9.0]), (101, [1.0, 2.0])], "row_id bigint, features array<double>")
    sc = {(r.row_id, r.label): r.score for r in NB.scores(model, pts, 2).collect()}
    assert all(math.isfinite(v) for v in sc.values())
    # row 101, class 0: prior 2/5; feature0 value 1 seen twice (k0=2), feature1 value 2 once (k1=3)
    expect = math.log(2 / 5) + math.log((2 + 1) / (2 + 2)) + math.log((1 + 1) / (2 + 3))
    assert abs(sc[(101, 0)] - expect) < 1e-12
    pred = {r.row_id: r.pred for r in NB.predict(model, pts, 2).collect()}
    assert pred[101] == 0


def test_nb_reference_score(spark):
    model = NB.fit(_nb_bag(spark))
    pts = spark.createDataFrame([(101, [1.0, 7.0])], "row_id bigint, features array<double>")
    sc = {r.label: r.score for r in NB.scores(model, pts, 2, kind="reference", smoothing=1.0).collect()}
    assert abs(sc[0] - (math.log(2 / 5) + 1.0 + 1.0)) < 1e-12   # p(1|0)=1, unseen -> 1.0
    assert abs(sc[1] - (math.log(3 / 5) + 1.0 + 1.0)) < 1e-12   # both unseen in class 1


def test_nb_labels_beyond_32_bits_and_136_features(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(m, i, 1, 5_000_000_000 * int(rng.integers(-1, 2)), [float(v) for v in rng.integers(0, 4, 136)])
            for m in range(2) for i in range(60)]
    bag = spark.createDataFrame(rows, "model_id int, row_id bigint, w int, label bigint, features array<double>")
    model = NB.fit(bag)
    pts = spark.createDataFrame([(i, [float(v) for v in rng.integers(0, 5, 136)]) for i in range(40)] + [(99, []), (98, None)],
                                "row_id bigint, features array<double>")
    scores = lambda: {(r.model_id, r.row_id, r.label): r.score for r in NB.scores(model, pts, 136).collect()}
    plan = NB.score_arrays(model, pts, 136)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    packed = scores()
    monkeypatch.setattr(NB, "fits_broadcast", lambda df: False)
    shuffled = scores()
    assert packed.keys() == shuffled.keys() and all(abs(packed[k] - shuffled[k]) < 1e-9 for k in packed)
    assert {r.pred for r in NB.predict(model, pts, 136).collect()} <= {-5_000_000_000, 0, 5_000_000_000}


def _brute_knn(train, query, k, metric, exclude_self):
    out = {}
    for qid, qf in query:
        ds = []
        for tid, lab, tf in train:
            if exclude_self and tid == qid:
                continue
            d = np.abs(np.subtract(qf, tf)).sum() if metric == "l1" else math.sqrt(((np.subtract(qf, tf)) ** 2).sum())
            ds.append((round(d, 9), tid, lab))
        ds.sort()
        top = ds[:k]
        counts = {}
        for _, _, lab in top:
            counts[lab] = counts.get(lab, 0) + 1
        out[qid] = min(counts, key=lambda lab: (-counts[lab], lab)) if counts else None
    return out


def test_exact_knn_matches_brute_force(spark):
    e = embedding_points(spark, SF001)
    rows = [(r.row_id, r.label, r.features) for r in e.collect()]
    for metric in ("l1", "l2"):
        got = {r.row_id: r.pred for r in K.predict(e, e, 5, metric, exclude_self=True).collect()}
        want = _brute_knn(rows, [(i, f) for i, _, f in rows], 5, metric, True)
        assert got == want


def test_knn_many_pivots_still_exact(spark):
    e = embedding_points(spark, SF001)
    rows = [(r.row_id, r.label, r.features) for r in e.collect()]
    nb = K.search(e, e, 3, "l1", exclude_self=True, pivots=40)
    got = {r.q_id: r.pred for r in K.vote(nb).collect()}
    assert got == _brute_knn(rows, [(i, f) for i, _, f in rows], 3, "l1", True)


def test_clustered_vectors_compare_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 50, (30, 8))
    x = (centres[rng.integers(0, 30, 1500)] + rng.normal(0, 1, (1500, 8))).round(3)
    rows = [(f"k{i:04d}", int(i % 4), v) for i, v in enumerate(x.tolist())]
    e = spark.createDataFrame(rows, "row_id string, label bigint, features array<double>")
    pairs, join = [], K._block_join

    def counted(t, q, keys, *rest):
        both = t.groupBy(*keys).count().join(q.groupBy(*keys).agg(F.count("*").alias("m")), keys)
        pairs.append(both.agg(F.sum(F.col("count") * F.col("m"))).first()[0] or 0)
        return join(t, q, keys, *rest)

    monkeypatch.setattr(K, "_block_join", counted)
    got = {r.row_id: r.pred for r in K.predict(e, e, 5, "l2", exclude_self=True, pivots=60).collect()}
    assert got == _brute_knn(rows, [(i, f) for i, _, f in rows], 5, "l2", True)
    assert sum(pairs) < 0.2 * len(rows) ** 2


def test_bagged_search_goes_on_for_small_bags(spark):
    rng = np.random.default_rng(2)
    rows = [(f"r{i}", int(rng.integers(0, 3)), rng.normal(0, 1, 4).round(3).tolist()) for i in range(120)]
    bag = [(m, i, int(rng.integers(1, 3)), lab, f) for m, share in ((3, 0.04), (4, 0.7), (5, 0.02))
           for i, lab, f in rows if rng.random() < share]
    b = spark.createDataFrame(bag, "model_id int, row_id string, w int, label bigint, features array<double>")
    q = spark.createDataFrame([(i, f) for i, _, f in rows], "row_id string, features array<double>")
    got = {(r.model_id, r.row_id): r.pred for r in K.bagged_predict(b, q, 3, "l1", 3, True, 3, spare=2).collect()}
    want = {}
    for m in (3, 4, 5):
        own = [(i, lab, f) for mm, i, w, lab, f in bag if mm == m for _ in range(w)]
        want |= {(m, i): p for i, p in _brute_knn(own, [(i, f) for i, _, f in rows], 3, "l1", True).items()}
    assert got == want


def test_lsh_recall_and_empty(spark):
    e = embedding_points(spark, SF001)
    rows = [(r.row_id, r.label, r.features) for r in e.collect()]
    near = lambda df: {(r.q_id, r.t_id) for r in df.collect()}
    exact = near(K.search(e, e, 5, "l2", exclude_self=True))
    keyed = K.lsh_keys("features", 6, 1, 4.0, 64, 3, True)
    probes = {(r.row_id, c.table, c.key) for r in e.select("row_id", keyed.alias("c")).collect() for c in r.c}
    own = {(r.row_id, c.table, c.key) for r in e.select("row_id", K.lsh_keys("features", 6, 1, 4.0, 64, 3).alias("c")).collect() for c in r.c}
    of = {}
    for i, t, c in own:
        of.setdefault((t, c), set()).add(i)
    met = {(q, t) for q, j, c in probes for t in of.get((j, c), ())}
    assert len(exact & met) >= 0.9 * len(exact)
    far = spark.createDataFrame([(-1, [1e6] + [0.0] * 63)], "row_id bigint, features array<double>")
    got = K.lsh_predict(e, far, 5, 6, 1, 4.0, 64, 3).collect()
    assert [(r.row_id, r.pred) for r in got] == [(-1, None)]


def test_empty_bucket_gives_null(spark):
    train = spark.createDataFrame([(1, 0, [0.0, 0.0]), (2, 1, [0.1, 0.0])],
                                  "row_id bigint, label bigint, features array<double>")
    query = spark.createDataFrame([(10, [0.05, 0.0]), (11, [50.0, 50.0])], "row_id bigint, features array<double>")
    got = {r.row_id: r.pred for r in K.bucketed_predict(train, query, 1, 1.0, "l1").collect()}
    assert got == {10: 0, 11: None}


def test_weighted_slots(spark):
    train = spark.createDataFrame([(0, 1, 3, 7, [0.0]), (0, 2, 1, 8, [1.0]), (0, 3, 1, 8, [1.5])],
                                  "model_id int, row_id bigint, w int, label bigint, features array<double>")
    query = spark.createDataFrame([(0, 10, [0.1])], "model_id int, row_id bigint, features array<double>")
    nb = K.search(train, query, 4, "l1", within=["model_id"]).collect()
    slots = {r.t_id: r.slots for r in nb}
    assert slots == {1: 3, 2: 1}
    assert K.vote(nb and K.search(train, query, 4, "l1", within=["model_id"]), ["model_id"]).collect()[0].pred == 7


def test_bayes_stream_scoring_matches_batch(spark, tmp_path):
    from copse.operators import bagging as B
    from copse.operators import encode as E
    from copse.operators import profile as P
    from copse.sources.tables import order_points
    from copse.streaming.score import score_bayes
    from tests.conftest import SF001 as SF
    pts = order_points(spark, SF)
    enc = E.encode(pts, P.profile(pts))
    model = NB.fit(B.poisson(enc, 3, 0.7, 5))
    batch = {(r.model_id, r.row_id): r.pred for r in NB.predict(model, enc, 6).collect()}
    src = tmp_path / "in"
    enc.select("row_id", "features").write.parquet(str(src))
    stream = spark.readStream.schema("row_id bigint, features array<double>").parquet(str(src))
    q = score_bayes(stream, model, 6).select("row_id", "preds").writeStream.format("memory") \
        .queryName("nb_stream").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    rows = spark.sql("SELECT * FROM nb_stream").collect()
    assert len(rows) == enc.count()
    for r in rows:
        assert list(r.preds) == [batch[(m, r.row_id)] for m in range(3)]


def _joins(monkeypatch):
    """(pairs met, queries sent, training rows) of every join of a search."""
    seen, join = [], K._block_join

    def counted(t, q, keys, *rest):
        both = t.groupBy(*keys).count().join(q.groupBy(*keys).agg(F.count("*").alias("m")), keys)
        seen.append((both.agg(F.sum(F.col("count") * F.col("m"))).first()[0] or 0, q.count()))
        return join(t, q, keys, *rest)

    monkeypatch.setattr(K, "_block_join", counted)
    return seen


def test_queries_are_sent_once_on_vectors_without_structure(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, v) for i, v in enumerate(rng.normal(0, 1, (600, 12)).tolist())]
    e = spark.createDataFrame(rows, "row_id bigint, label bigint, features array<double>")
    seen = _joins(monkeypatch)
    got = {r.row_id: r.pred for r in K.predict(e, e, 5, "l2", exclude_self=True, pivots=30).collect()}
    assert got == _brute_knn(rows, [(i, f) for i, _, f in rows], 5, "l2", True)
    assert all(sent <= len(rows) for _, sent in seen) and sum(pairs for pairs, _ in seen) <= len(rows) ** 2


def test_estimates_far_from_the_origin_and_ties(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate((rng.integers(0, 3, (300, 5)) + 1e6, rng.normal(0, 1e-4, (100, 5)) - 7e5))
    rows = [(f"r{i:03d}", i % 3, v) for i, v in enumerate(x.tolist())]
    e = spark.createDataFrame(rows, "row_id string, label bigint, features array<double>")
    for metric in ("l1", "l2"):
        got = {r.row_id: r.pred for r in K.predict(e, e, 4, metric, exclude_self=True, pivots=20).collect()}
        want = {}
        for i, _, f in rows:
            d = sorted((round(float(K._distances(metric, np.array([f]), np.array([g]))[0, 0]), 9), j, lab) for j, lab, g in rows if j != i)
            counts = {}
            for _, _, lab in d[:4]:
                counts[lab] = counts.get(lab, 0) + 1
            want[i] = min(counts, key=lambda lab: (-counts[lab], lab))
        assert got == want


def test_hashed_search_compares_a_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (400, 16))
    rows = [(i, i % 3, v) for i, v in enumerate(x.tolist())]
    e = spark.createDataFrame(rows, "row_id bigint, label bigint, features array<double>")
    for width, projections in ((4.0, 1), (0.5, 2)):
        seen = _joins(monkeypatch)
        got = {r.row_id: r.pred for r in K.lsh_predict(e, e, 5, 3, projections, width, 16, 3, exclude_self=True).collect()}
        keys = K.lsh_cells("features", 3, projections, width, 16, 3)
        cells = {r[0]: np.array(r[1]) for r in e.select("row_id", F.array(*[F.array(*c) for c in keys])).collect()}
        met = lambda a, b: (np.abs(cells[a] - cells[b]).sum(axis=1) <= 1).any()
        want = {i: None for i, _, _ in rows}
        for i, _, f in rows:
            want |= _brute_knn([r for r in rows if r[0] != i and met(i, r[0])], [(i, f)], 5, "l2", True)
        assert got == want
        assert sum(pairs for pairs, _ in seen) <= len(rows) ** 2
        monkeypatch.undo()


def test_repeated_and_missing_ids(spark):
    rows = [(1, 0, [0.0, 0.0]), (1, 1, [0.0, 9.0]), (2, 1, [0.0, 1.0]), (None, 2, [0.0, 5.0]), (None, 2, [0.0, 6.0]), (3, 2, [0.0, 5.5])]
    e = spark.createDataFrame(rows, "row_id bigint, label bigint, features array<double>")
    nb = K.search(e, e, 2, "l2", exclude_self=True).collect()
    # Equal ids are left out; rows without an id are not each other's copies.
    assert not [r for r in nb if r.q_id is not None and r.q_id == r.t_id]
    assert [(r.t_id, r.dist) for r in nb if r.q_id is None] == [(None, 0.0)] * 2
    assert {(r.t_id, r.dist) for r in nb if r.q_id == 3} == {(None, 0.5)}
    hashed = K.lsh_predict(e, e.where("row_id = 3"), 2, 2, 1, 100.0, 2, 3, exclude_self=True).collect()
    assert [r.row_id for r in hashed] == [3] and hashed[0].pred is not None


@pytest.mark.parametrize("kind", ["plain", "ties", "far", "one", "odd", "wide", "late"])
def test_l1_estimates_in_bytes_lose_no_neighbour(kind, monkeypatch):
    """Batches of training rows against all distances; how many pairs' distances
    are computed is counted for plain vectors."""
    rng = np.random.default_rng(3)
    dim = {"one": 1, "odd": 33, "wide": 600}.get(kind, 64)
    t = rng.normal(size=(9000, dim))
    if kind == "ties":
        t = np.round(t)
    if kind == "far":
        t[4000:4010] *= 1e6
    if kind == "late":
        t[500:] += 40
    q, k = t[:130], 5
    computed, plain = [], K._pair_distances
    monkeypatch.setattr(K, "_pair_distances", lambda m, a, b, i, j: computed.append(len(i)) or plain(m, a, b, i, j))
    best = K._Best("l1", k, q, np.full(len(q), np.nan), list(range(len(q))))
    for lo in range(0, len(t), 1000):
        some = t[lo:lo + 1000]
        best.add(some, list(range(lo, lo + len(some))), pa.table({"x": pa.array(range(lo, lo + len(some)))}))
    dist = K._distances("l1", q, t)
    rd = np.round(dist, 9)
    rd[np.arange(len(q)), np.arange(len(q))] = np.inf
    want = np.argsort(rd, axis=1, kind="stable")[:, :k]
    assert (best.seq == want).all()
    assert (best.dist == np.take_along_axis(dist, want, axis=1)).all()
    assert (best.levels is not None) if kind != "wide" else best.steps is None
    if kind == "plain":
        assert best.steps is not None and sum(computed) < 0.05 * q.shape[0] * len(t)
