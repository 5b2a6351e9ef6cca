import pytest
from pyspark.sql import functions as F

from copse.llm import mixing

SCHEMA = "doc_id long, source string, text string, target int"


def docs(spark):
    rows = [(i, f"s{i % 4}", "w " * (1 + i % 7), 0) for i in range(4000) if i % 4 != 3 or i < 40]
    rows += [(None, None, "a b", 0), (1, "s1", "w w", 0), (5000, "z", None, 0), (5001, "z", "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def water_level(sizes, weights):
    """Targets by raising shares round after round."""
    total, target, free, left = sum(sizes), {}, set(range(len(sizes))), sum(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] >= 3 * sizes[i]}
        if not over:
            return {**target, **{i: level * weights[i] for i in free}}
        for i in over:
            target[i] = 3 * sizes[i]
        left -= sum(3 * sizes[i] for i in over)
        free -= over
    return target


def test_targets_stop_at_three_times_the_source(spark):
    plan = mixing.source_plan(docs(spark)).collect()
    order = sorted(plan, key=lambda r: (r.source is None, r.source or ""))
    assert [r.weight for r in order] == [1, 2, 3, 1, 2, 3][:len(order)]
    want = water_level([r.source_size for r in order], [r.weight for r in order])
    for i, r in enumerate(order):
        assert r.target == pytest.approx(want[i])
        assert r.target <= 3 * r.source_size


def test_taken_words_come_near_the_targets_and_agree_on_reruns(spark):
    a = mixing.copies(docs(spark), 5)
    rows = sorted(map(tuple, a.collect()), key=str)
    assert rows == sorted(map(tuple, mixing.copies(docs(spark).repartition(7), 5).collect()), key=str)
    assert all(c <= 3 for *_, c in rows)
    per = a.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    for r in per:
        assert r.source_size < 100 or abs(r.taken - r.target) < 0.1 * r.target


def test_mix_emits_each_copy_with_all_columns(spark):
    d = docs(spark)
    out = mixing.mix(d, 5)
    assert out.columns == d.columns + ["copy_no"]
    n = mixing.copies(d, 5).agg(F.sum("copies")).first()[0]
    assert out.count() == n


def test_mix_of_a_mix(spark, tmp_path):
    d = mixing.mix(docs(spark), 5).withColumnRenamed("copy_no", "Copy_No")
    out = mixing.mix(d, 5)
    assert out.columns == d.columns + ["copy_no_"]
    out.write.parquet(f"{tmp_path}/mixed")


def test_empty_table(spark):
    d = spark.createDataFrame([], SCHEMA)
    assert mixing.copies(d).count() == 0 and mixing.mix(d).count() == 0
    d = spark.createDataFrame([(1, "a", None, 0)], SCHEMA)
    assert [tuple(r) for r in mixing.copies(d).collect()] == [(1, 0, 0, 0.0, 0)]
