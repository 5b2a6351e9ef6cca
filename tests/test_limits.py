"""Nothing but the input's size decides a result: no cap, prefix or tuning
knob changes it."""

import pytest
from pyspark.sql import functions as F

from copse.functions import draws
from copse.operators import bagging, ensemble, tree, vote
from copse.sources import profile_io
from copse.sources.text import parse_ranked, read_lines


def _bag(spark):
    """Eleven models that are pure at once and one that needs three levels."""
    rows = [(m, 0, 1, 0, [float(i), 0.0]) for m in range(11) for i in range(3)]
    rows += [(11, i, 1, (i // 2) % 2, [float(i), 0.0]) for i in range(8)]
    return spark.createDataFrame(rows, "model_id int, row_id long, w int, label long, features array<double>")


def test_tree_growth_does_not_depend_on_what_is_compiled(spark, monkeypatch):
    def grown():
        return sorted(map(tuple, tree.fit(_bag(spark), 3, 1).drop("impurity").collect()), key=str)

    want = grown()
    assert len([r for r in want if r[0] == 11]) > 3
    monkeypatch.setattr(tree, "COMPILE_MAX_NODES", 2)
    assert grown() == want


def test_vote_of_large_node_tables(spark, monkeypatch):
    nodes = tree.fit(_bag(spark), 3, 1).persist()
    points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(8)], "row_id long, features array<double>")
    want = sorted(map(tuple, tree.predict_vote(nodes, points).collect()))
    voted = vote.majority(tree.predict(nodes, points, 3))
    assert sorted(map(tuple, voted.select("row_id", "pred", "votes").collect())) == want
    monkeypatch.setattr(tree, "COMPILE_MAX_NODES", 2)
    got = tree.predict_vote(nodes, points).select("row_id", "pred", "votes")
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("n", [1000, 50_000])
def test_long_lines_parse(spark, n):
    line = "3 qid:7 " + " ".join(f"{i}:{i}.5" for i in range(n))
    df = spark.createDataFrame([(1, line), (2, line + " 5"), (3, line + " 1:nan"), (4, "3 qid:7")], "id long, value string")
    good, bad = parse_ranked(df, key="id", mode="quarantine")
    assert [(r.row_id, len(r.features), r.features[-1]) for r in good.collect()] == [(1, n, n - 0.5)]
    assert {r.row_id for r in bad.collect()} == {2, 3, 4}


def test_content_ids_have_128_bits_and_tell_copies_apart(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 qid:1 1:2\n1 qid:1 1:2\n")
    (tmp_path / "b.txt").write_text("1 qid:1 1:2\n0 qid:1 1:3\n")
    ids = [r.row_id for r in parse_ranked(read_lines(spark, str(tmp_path))).collect()]
    assert len(set(ids)) == 4 and all(len(i) == 32 for i in ids)


@pytest.mark.parametrize("buckets", [1, 16, 17, 1000])
def test_replacement_bags_do_not_depend_on_buckets(spark, buckets):
    points = spark.range(2000).select(F.col("id").alias("row_id"))
    slots = lambda n: sorted(map(tuple, bagging.keep_or_replace_slots(points, 2, 0.5, 3, n).collect()))
    assert slots(buckets) == slots(64)


@pytest.mark.parametrize("rate", [0.7, 5.0, 300.0, 2000.0])
def test_poisson_weights_have_the_rate_as_mean(spark, rate):
    df = spark.range(4000).select(draws.poisson_weight(draws.uniform(1, 0, F.col("id")), rate).alias("w"))
    mean, var = df.agg(F.avg("w"), F.var_samp("w")).first()
    assert abs(mean - rate) < 5 * (rate / 4000) ** 0.5
    assert 0.85 * rate < var < 1.15 * rate


def test_draws_have_52_bits(spark):
    h = [r[0] for r in spark.range(1000).select(draws.hash52(F.col("id"))).collect()]
    assert max(h) > 2**51 and len({x % 2**20 for x in h}) > 900


def test_profiles_in_several_files_keep_their_order(spark, tmp_path):
    (tmp_path / "part-0").write_text("1,1,10,0,1\n1,1,11,0,1\n")
    (tmp_path / "part-1").write_text("".join(f"1,1,{n},0,{'1' * 30}\n" for n in range(12, 17)))
    got = profile_io.read_profile(spark, str(tmp_path)).orderBy("feature").collect()
    assert [r.num_distinct for r in got] == list(range(10, 17)) and [r.feature for r in got] == list(range(7))


def test_split_uses_every_row_once(spark):
    points = spark.range(1000).select(F.col("id").alias("row_id"))
    train, test = ensemble.split(points, 0.2)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not a & b and len(a | b) == 1000 and 140 < len(b) < 260


def test_equal_keys_and_empty_vectors_are_scored(spark, monkeypatch):
    from copse.operators import bayes
    rows = [(0, i, 1, i % 2, [float(i % 3), float(i % 2)]) for i in range(30)]
    bag = spark.createDataFrame(rows, "model_id int, row_id long, w int, label long, features array<double>")
    model = bayes.fit(bag)
    points = spark.createDataFrame([(1, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [])], "row_id long, features array<double>")

    def scored():
        arrays, _ = bayes.score_arrays(model, points, 2)
        return sorted((r.row_id, [round(x, 9) for x in r.scores]) for r in arrays.collect())

    want = scored()
    assert [r[0] for r in want] == [1, 1, 2]
    plan = bayes.score_arrays(model, points, 2)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(bayes, "ROW_LOCAL_FEATURES", 0)
    assert scored() == want
