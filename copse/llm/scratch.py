"""Step tables in the shared folder that the session names.

Operators that need several jobs write each step as Parquet below
``spark.checkpoint.dir`` and go on from the files, so a lost executor
costs one step at most. Where the session names no folder, a local master
(tests) uses its warehouse folder, and any other is refused.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def root(spark: SparkSession) -> str:
    conf = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not conf and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (conf or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


class Steps:
    """One run's folder of step tables. ``drop`` removes steps that nothing
    reads any more; the last ones stay, as the result reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{root(spark)}/copse-{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.folder}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._copse_path = path
        return out

    def bucketed(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """As ``save``, one file for each bucket of ``key``: joins on it shuffle
        the other side only. ``df`` is a saved step, so retries agree on it."""
        parts, table = shuffle_parts(self.spark), f"copse_{name}_{uuid.uuid4().hex}"
        df.repartition(parts, key).write.option("path", self.path(name)).bucketBy(parts, key).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, *tables: DataFrame) -> None:
        """Empties step tables that nothing reads any more."""
        for t in tables:
            self.spark.createDataFrame([], t.schema).write.mode("overwrite").parquet(t._copse_path)

    def release(self) -> None:
        """Has the shuffle files of finished steps deleted now. Spark deletes
        them when the driver's garbage collection meets their plans, which a
        driver with memory to spare puts off while the disks of executors fill.
        The last step's plan is still held for a moment by what records its end,
        so its files go with a second collection."""
        for pause in (0, 0.5):
            time.sleep(pause)
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def broadcast_if_small(df: DataFrame, limit_bytes: int = 16 << 20) -> DataFrame:
    """Broadcast hint for a step table whose rows, counted now, stay within
    ``limit_bytes`` as text; beyond it the join is left to a shuffle."""
    n, size = df.select(F.count("*"), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if n == 0 or size <= limit_bytes else df
