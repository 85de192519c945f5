"""Helpers for joins and rankings that must hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.materialise import materialise

SMALL_BYTES = 16 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Mark a lookup for broadcast once its written size is known to be within `max_bytes`.

    The lookup is materialised first, so it is computed once, and its files are as large as they are
    however wide its rows. Above the bound it is returned unmarked, and Spark picks a shuffled join (with
    skew splitting by AQE).
    """
    df = materialise(df)
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= max_bytes:
        return F.broadcast(df)
    return df


def left_join_known(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: str, buckets: int = 1024
) -> DataFrame:
    """Left join in which rows with a null key are spread over `buckets` instead of one task.

    `right` must be unique on `on`; null keys never match, as in a plain left join.
    """
    unknown = F.lit(False)
    for c in on:
        unknown = unknown | F.col(c).isNull()
    bucket = F.when(unknown, -1 - F.pmod(F.hash(spread_by), F.lit(buckets))).otherwise(F.lit(0))
    return (
        left.withColumn("_bucket", bucket)
        .join(right.withColumn("_bucket", F.lit(0)), [*on, "_bucket"], "left")
        .drop("_bucket")
    )


def rank_all(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows 1..n in one global order, without one task or partition that must hold a tie.

    Rows are dealt into ranges of the order, which must be complete, and written sorted; each range
    starts where the ones before it end. Only the sizes of the ranges reach the driver.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(ranged.withColumn("_row", F.monotonically_increasing_id()))
    part, within = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for row in ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").toLocalIterator():
        starts.append((row["part"], total))
        total += row["n"]
    if not starts:
        return ranged.withColumn(name, F.col("_row")).drop("_row")
    start = spark.createDataFrame(starts, "_part bigint, _start bigint")
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(start), "_part")
        .withColumn(name, F.col("_start") + within + 1)
        .drop("_part", "_start", "_row")
    )
