import math

from pyspark.sql import functions as F

from copse.functions.draws import poisson_cuts
from copse.operators import bagging as B
from copse.operators import encode as E
from copse.operators import profile as P
from copse.sources.tables import order_points
from tests.conftest import SF01


def _profile(spark, rows):
    return spark.createDataFrame(rows, "feature int, is_categorical int, is_ordinal int, "
                                       "num_distinct bigint, min double, max double")


def test_negative_bin(spark):
    prof = _profile(spark, [(0, 0, 0, 5000, -10.0, 10.0)])
    pts = spark.createDataFrame([(1, [-3.0])], "row_id bigint, features array<double>")
    assert E.encode(pts, prof).collect()[0].features == [-1.0]   # width 20/5 = 4


def test_min_equals_max_bin_zero(spark):
    prof = _profile(spark, [(0, 0, 0, 5000, 7.0, 7.0), (1, 1, 1, 3, 0.0, 2.0)])
    pts = spark.createDataFrame([(1, [7.0, 2.0])], "row_id bigint, features array<double>")
    assert E.encode(pts, prof).collect()[0].features == [0.0, 2.0]


def test_profile_rule(spark):
    prof = {r.feature: r for r in P.profile(order_points(spark, SF01)).collect()}
    assert prof[0].is_categorical == 0 and prof[0].n_buckets == prof[0].num_distinct // 1000 + 1
    assert prof[2].is_categorical == 1 and prof[2].num_distinct == 12


def test_bags_independent_of_partitioning(spark):
    pts = order_points(spark, SF01)
    a = B.poisson(pts, 3, 0.7, 7).select("model_id", "row_id", "w")
    b = B.poisson(pts.repartition(5), 3, 0.7, 7).select("model_id", "row_id", "w")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_poisson_mean(spark):
    pts = order_points(spark, SF01)
    n = pts.count()
    tot = B.poisson(pts, 2, 0.7, 1).agg(F.sum("w")).first()[0]
    assert abs(tot / (2 * n) - 0.7) < 0.02
    cuts = poisson_cuts(1.0)
    assert abs(cuts[0] - math.exp(-1)) < 1e-15 and 1 - cuts[-1] < 1e-12


def test_bernoulli_fraction(spark):
    pts = order_points(spark, SF01)
    n = pts.count()
    got = B.bernoulli(pts, 1, 0.3, 3).count()
    assert abs(got / n - 0.3) < 0.02


def test_ordinals_dense(spark):
    pts = order_points(spark, SF01)
    o, n = B.ordinals(pts, 16)
    assert n == pts.count()
    r = o.agg(F.min("ordinal"), F.max("ordinal"), F.countDistinct("ordinal")).first()
    assert tuple(r) == (0, n - 1, n)


def test_keep_or_replace_slots(spark):
    pts = order_points(spark, SF01)
    slots = B.keep_or_replace_slots(pts, 2, 0.7, 5, 16)
    n = pts.count()
    assert slots.count() == 2 * n
    kept = slots.where(F.col("slot_id") == F.col("row_id")).count()
    assert 0.65 < kept / (2 * n) < 0.75


def test_fixed_sample_size(spark):
    pts = order_points(spark, SF01)
    s = B.fixed_sample(pts, 100, 9)
    assert s.count() == 100 and s.select("row_id").distinct().count() == 100


def test_ordinal_buckets_grow_with_rows(spark):
    pts = order_points(spark, SF01)
    o, n = B.ordinals(pts, 2, rows_per_bucket=1000)   # forces ceil(n / 1000) buckets
    r = o.agg(F.min("ordinal"), F.max("ordinal"), F.countDistinct("ordinal")).first()
    assert tuple(r) == (0, n - 1, n)


def test_weights_of_a_row_are_the_bags(spark):
    from copse.operators import bagging
    rows = [(i if i % 7 else None, i % 3, [float(i)]) for i in range(200)]
    pts = spark.createDataFrame(rows, "row_id bigint, label bigint, features array<double>")
    names = ["model_id", "row_id", "label", "features", "w"]
    every = lambda df: sorted(map(str, df.select(names).collect()))
    for method in ("poisson", "bernoulli"):
        got = bagging.spread_bags(bagging.drawn(pts, 5, 0.7, 3, method))
        assert every(got) == every(bagging.bags(pts, 5, 0.7, 3, method))


def test_trees_draw_a_row_once(spark, monkeypatch):
    from copse.operators import bagging, tree
    pts = spark.createDataFrame([(i, i % 2, [float(i % 5), float(i % 3)]) for i in range(60)],
                                "row_id bigint, label bigint, features array<double>")
    plans, fit = [], tree.fit

    def seen(bag, *rest, **more):
        plans.append(bag._jdf.queryExecution().withCachedData().toString())
        return fit(bag, *rest, **more)

    monkeypatch.setattr(tree, "fit", seen)
    assert tree.fit_bags(pts, 3, 0.7, 1, 2).count() > 0
    # Outside of the cached relation nothing is drawn.
    assert "md5" not in plans[0].split("InMemoryRelation")[0]
    assert bagging.drawn(pts, 3, 0.7, 1, "poisson").columns[-1] == "ws"
