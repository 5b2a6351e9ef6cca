import pytest
from pyspark.sql import functions as F

from copse.sources.profile_io import read_profile, write_profile
from copse.sources.tables import order_points
from copse.sources.text import content_row_id, format_ranked, parse_ranked, read_lines
from copse.operators import profile as P
from tests.conftest import SF001


def _lines(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "row_id bigint, value string")


def test_parse_trailing_space(spark):
    pts = parse_ranked(_lines(spark, ["2 qid:10 1:0.5 2:1.0 "]), key="row_id")
    r = pts.collect()[0]
    assert (r.label, r.qid, r.features) == (2, 10, [0.5, 1.0])


def test_parse_modes(spark):
    df = _lines(spark, ["0 qid:11 1:x 2:1", "bad", "1 qid:3 1:2.5 2:4", "1 qid:3 1:2:3 2:4"])
    assert [r.row_id for r in parse_ranked(df, key="row_id", mode="drop").collect()] == [2]
    good, bad = parse_ranked(df, key="row_id", mode="quarantine")
    reasons = {r.row_id: r.reason for r in bad.collect()}
    assert reasons == {0: "bad feature", 1: "bad label", 3: "bad feature"}
    assert good.count() == 1
    with pytest.raises(Exception):
        parse_ranked(df, key="row_id", mode="fail").collect()


def test_parse_feature_count(spark):
    df = _lines(spark, ["1 qid:1 1:1 2:2", "1 qid:1 1:1"])
    assert parse_ranked(df, key="row_id", n_features=2).count() == 1


def test_round_trip_orders(spark):
    pts = order_points(spark, SF001)
    back = parse_ranked(format_ranked(pts), key="row_id", mode="fail")
    a = {r.row_id: (r.label, r.qid, tuple(r.features)) for r in pts.collect()}
    b = {r.row_id: (r.label, r.qid, tuple(r.features)) for r in back.collect()}
    assert a == b


def test_text_scan_content_ids(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("1 qid:1 1:1\n1 qid:1 1:1\n2 qid:2 1:5\n1 qid:1 1:1\n")
    lines = read_lines(spark, str(path))
    ids = content_row_id(lines)
    rows = ids.collect()
    assert len(rows) == 4 and len({r.row_id for r in rows}) == 4
    again = content_row_id(read_lines(spark, str(path)).repartition(3))
    assert sorted(r.row_id for r in again.collect()) == sorted(r.row_id for r in rows)
    pts = parse_ranked(read_lines(spark, str(path)))
    assert pts.count() == 4


def test_profile_file_round_trip(spark, tmp_path):
    prof = P.profile(order_points(spark, SF001))
    write_profile(prof, str(tmp_path / "meta"))
    back = read_profile(spark, str(tmp_path / "meta"))
    cols = ["feature", "is_categorical", "is_ordinal", "num_distinct", "min", "max", "n_buckets"]
    assert sorted(map(tuple, prof.select(cols).collect())) == sorted(map(tuple, back.select(cols).collect()))


def test_vectors_densified(spark):
    from pyspark.ml.linalg import Vectors
    from copse.sources.tables import as_points
    df = spark.createDataFrame([(1, Vectors.sparse(3, [1], [2.5])), (2, Vectors.dense([1.0, 0.0, 3.0]))],
                               ["row_id", "features"])
    got = {r.row_id: r.features for r in as_points(df).collect()}
    assert got == {1: [0.0, 2.5, 0.0], 2: [1.0, 0.0, 3.0]}
    arr = spark.createDataFrame([(1, [1, 2])], "row_id bigint, features array<int>")
    assert as_points(arr).collect()[0].features == [1.0, 2.0]
