"""Cutting lineage in iterative jobs (tree levels, k-NN widening rounds).

Iterative operators write each step's (small) result as a table in the
shared folder named by ``spark.checkpoint.dir`` and continue from the
written files, so a lost executor does not force recomputation of every
earlier level. ``localCheckpoint`` is never used: its blocks live on
executors and die with them.

The folder is the session's ``spark.checkpoint.dir``. Where that is unset,
a local master (tests, the bench) uses its warehouse folder, and any other is
refused: the default warehouse is a folder of the driver alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def step_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` as a parquet table under the shared checkpoint
    folder and return a frame that reads it back.

    One job writes the table (``Dataset.checkpoint`` would compute the plan
    twice: once for its eager count and again to write the files). The
    read-back plan starts at the files, carries their true size for
    later broadcast decisions, and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{step_folder(spark)}/copse-tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
