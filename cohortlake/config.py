"""Where the tables are, passed to the jobs as an argument."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """Locations under one root: `source` holds the inputs, `target` what the jobs write."""

    source: str
    target: str

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.source}/{name}")

    def built(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.target}/{name}"


# The JVM doesn't compile methods of more than 8,000 bytes of code, and Spark makes one method of a whole stage. Stages with
# that many expressions are then run operator by operator, whose methods are cut into small ones.
COMPILED = ("spark.sql.codegen.hugeMethodLimit", "8000")

# settings the jobs are meant to run with; sizes of shuffles and joins are left to AQE
SESSION = {
    COMPILED[0]: COMPILED[1],
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}
