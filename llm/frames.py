"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions import materialise as shared

#: Settings for the jobs that write intermediate tables: shuffle files go when the job ends, and batches of long
#: texts stay small in the JVM and in Python.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

__all__ = ["crc_part", "materialise", "own", "table"]


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared scratch folder and go on from the written rows.

    The shuffle files of the job are released when it ends, as nothing reads them again.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            conf.set(key, value)
        return shared.materialise(df)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_part(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def own(*names: str) -> list[str]:
    """Fresh column names that no input column can clash with."""
    tag = uuid.uuid4().hex[:8]
    return [f"_{n}_{tag}" for n in names]
