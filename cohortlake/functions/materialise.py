"""Results that several later steps read are computed once and written to the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's `spark.checkpoint.dir`.

    Only a local session without one gets a folder of its own.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def materialise(df: DataFrame) -> DataFrame:
    """Compute now, write to the shared folder as a table, and go on from the written rows.

    The plan is cut there, the loss of an executor later does not cause a recomputation, readers
    take only the columns they need, and Spark knows the size when it picks a join. The folder is
    the cluster's scratch space; its clean-up is left to the cluster.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
