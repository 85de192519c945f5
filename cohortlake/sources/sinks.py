"""Writing tables: partitioned, replaced partition by partition, or built when absent."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlake.operators.cohorts import merge_cohorts

PARTITIONS = ("fyear", "provider")


def _spread(df: DataFrame, partitions: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Rows of a partition together, but with large partitions split and small ones joined by AQE."""
    df = df.hint("rebalance", *partitions)
    return df.sortWithinPartitions(*partitions, *sort) if sort else df


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, sort: Sequence[str] = ()
) -> None:
    """Replace the whole table."""
    _spread(df, partitions, sort).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partitions
    ).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, sort: Sequence[str] = ()
) -> None:
    """Replace only the partitions that occur in `df`."""
    _spread(df, partitions, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions
    ).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_extract(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """Extract by year and dataset: one file each, or several where a dataset is large."""
    write_partitioned(df, path, ("fyear", "dataset"), sort)


def merge_into(spark: SparkSession, path: str, current: DataFrame, recomputed: Sequence[tuple[str, str]], version: str) -> str:
    """Merge recomputed cohorts into a stored table, written next to it as a new version.

    The new state is computed from the old files, so these are left in place; returns the new path.
    """
    merged = merge_cohorts(spark.read.parquet(path), current, recomputed)
    target = f"{path.rstrip('/')}-{version}"
    write_partitioned(merged.filter("action <> 'delete'").drop("action"), target, sort=("strategy", "epikey"))
    return target


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has finished."""
    jvm = spark._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def build_if_absent(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read a table, building and writing it first if it was not completed before."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
