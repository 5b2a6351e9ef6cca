from pyspark.sql import functions as F

from copse.operators import evaluate as EV
from copse.operators import profile as P
from copse.sources.report import metric_report, write_predictions
from copse.sources.tables import order_points
from tests.conftest import SF001


def test_metric_report_and_prediction_sink(spark, tmp_path):
    j = spark.createDataFrame([(1, 1, 1), (2, 0, 1)], "row_id bigint, pred bigint, label bigint")
    rep = metric_report(EV.accuracy(j), k=5, n_models=4, fraction=0.7).collect()[0]
    assert (rep.n_total, rep.n_correct, rep.accuracy_pct) == (2, 1, 50.0)
    assert (rep.k, rep.n_models, rep.fraction) == (5, 4, 0.7)
    write_predictions(j, str(tmp_path / "preds"))
    back = spark.read.parquet(str(tmp_path / "preds"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, j.collect()))


def test_limit_rows_and_label_domain(spark):
    pts = order_points(spark, SF001)
    first = EV.limit_rows(pts, 10)
    keys = [r.row_id for r in first.collect()]
    assert keys == sorted(r.row_id for r in pts.collect())[:10]
    assert EV.limit_rows(pts, -1).count() == pts.count()
    labels = sorted(r.label for r in P.label_domain(pts).collect())
    assert labels == [0, 1, 2, 3, 4]


def test_correct_filter(spark):
    j = spark.createDataFrame([(1, 1, 1), (2, 0, 1), (3, None, 1)], "row_id bigint, pred bigint, label bigint")
    assert [r.row_id for r in EV.correct(j).collect()] == [1]
