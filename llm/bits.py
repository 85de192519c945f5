"""A small map of what a step concerns, so that the rest needs no shuffle. Its size is fixed; at its worst it lets all through."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.frames import materialise

#: Bits in one row of a map.
ROW = 32768


def bucket_of(*keys: str) -> Column:
    """One of 2**22 buckets: half a megabyte in all."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 22))


def needed(rows: DataFrame, bucket: Column) -> DataFrame:
    """`(part, bits)`: a bit for each bucket number, set if one of `rows` has it."""
    numbers = rows.select((bucket + 1).alias("b"))
    return materialise(
        numbers.groupBy((F.bitmap_bucket_number("b") - 1).cast("int").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")
        )
    )


def may_need(docs: DataFrame, found: DataFrame, bucket: Column, name: str) -> DataFrame:
    """Append `name`: false only for rows whose bucket `needed` has not seen."""
    mine = found.select(F.col("part").alias(f"{name}p"), F.col("bits").alias(f"{name}b"))
    # half a megabyte, as the buckets are 2**22
    joined = docs.join(F.broadcast(mine), F.floor(bucket / ROW).cast("int") == F.col(f"{name}p"), "left")
    position = F.pmod(bucket, F.lit(ROW)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(f"{name}b"), F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(position, F.lit(8)))), F.lit(2))
    return joined.withColumn(name, F.coalesce(bit.cast("int") == 1, F.lit(False))).drop(f"{name}p", f"{name}b")


def as_array(found: DataFrame, buckets: int) -> np.ndarray:
    """The map as one byte array of `buckets` bits."""
    out = np.zeros(buckets // 8, np.uint8)
    for row in found.toLocalIterator():
        begin = row["part"] * (ROW // 8)
        out[begin : begin + ROW // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def test(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bits[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1
