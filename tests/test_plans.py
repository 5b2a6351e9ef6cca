import pytest
from pyspark.sql import functions as F

from copse.plans.broadcast import bounded_broadcast, checked_broadcast
from copse.plans.lineage import cut_lineage, step_folder
from copse.plans.partitioning import parallelism, spread
from copse.sources.tables import table
from tests.conftest import SF001


def _hinted(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_checked_broadcast_respects_limit(spark):
    small = spark.range(10)
    assert _hinted(checked_broadcast(small, 100))
    assert not _hinted(checked_broadcast(small, 5))
    assert _hinted(bounded_broadcast(small, 10, 100))
    assert not _hinted(bounded_broadcast(small, 10_000, 5))


def test_cut_lineage_reads_back_from_checkpoint_folder(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "Range" not in plan
    assert sorted(r.x for r in cut.collect()) == [2 * i for i in range(100)]
    assert all(f.startswith(("file:", "/")) and "/copse-tables/" in f for f in cut.inputFiles())


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = conf


def test_a_cluster_needs_a_shared_folder():
    warehouse = {"spark.sql.warehouse.dir": "file:/here/"}
    assert step_folder(FakeSession("local[4]", **warehouse)) == "file:/here"
    with pytest.raises(RuntimeError):
        step_folder(FakeSession("spark://host:7077", **warehouse))
    named = warehouse | {"spark.checkpoint.dir": "/shared/steps/"}
    assert step_folder(FakeSession("spark://host:7077", **named)) == "/shared/steps"


def test_spread_only_when_too_few_partitions(spark):
    one = table(spark, SF001, "orders").select("o_orderkey")
    assert one.rdd.getNumPartitions() == 1
    spread_one = spread(one, "o_orderkey")
    assert spread_one.rdd.getNumPartitions() == parallelism(spark)
    wide = spark.range(0, 1000, numPartitions=parallelism(spark) + 2)
    assert spread(wide, "id") is wide
