"""A partitioned table in versions: a version writes only the partitions that changed, and one marker switches to it.

    root/data/version=3/fyear=201920/provider=RAB/...   files of the partitions that version 3 changed
    root/manifest/version=3/                            which version holds each partition as of version 3

The current state is the last manifest whose write has finished; until then readers see the one before, so a
run that stops half-way changes nothing and can be repeated. There is one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.materialise import materialise
from cohortlake.operators.cohorts import MERGE_KEY, merge_cohorts
from cohortlake.sources.sinks import PARTITIONS, _spread, is_complete

VERSION = "version"


def _folder(spark: SparkSession, path: str):
    """The Hadoop path of a folder and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all version folders, finished or not."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}="))


def finished_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that can be read, oldest first."""
    return [v for v in _versions(spark, f"{root}/manifest") if is_complete(spark, f"{root}/manifest/{VERSION}={v}")]


def _manifest(spark: SparkSession, root: str, version: int) -> tuple[T.StructType, dict[tuple, int]]:
    """Schema of the table, and the version that holds each partition: what Spark's own file index keeps of a table."""
    rows = spark.read.json(f"{root}/manifest/{VERSION}={version}/", schema="state string").collect()
    state = json.loads(rows[0]["state"])
    return T.StructType.fromJson(state["schema"]), {tuple(p): v for *p, v in state["partitions"]}


def _switch(spark: SparkSession, root: str, version: int, schema: T.StructType, held: dict[tuple, int]) -> None:
    """Make `version` the current one: it is from the moment its manifest is marked as finished."""
    state = {"schema": schema.jsonValue(), "partitions": [[*p, v] for p, v in held.items()]}
    one = spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1)
    one.write.json(f"{root}/manifest/{VERSION}={version}")


def _read(spark: SparkSession, root: str, schema: T.StructType, held: dict[tuple, int], partitions: Sequence[str]) -> DataFrame:
    """The given partitions, from the folders of the versions that hold them."""
    if not held:
        return spark.createDataFrame([], schema)
    files = T.StructType([f for f in schema if f.name not in partitions] + [schema[p] for p in partitions])
    paths = [f"{root}/data/{VERSION}={v}/" + "/".join(f"{c}={x}" for c, x in zip(partitions, p)) for p, v in held.items()]
    files = files.add(VERSION, "long")
    return spark.read.schema(files).option("basePath", f"{root}/data").parquet(*paths).select(*schema.names)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None, partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """The table as of a version, the last finished one if none is given."""
    finished = finished_versions(spark, root)
    if not finished or (version is not None and version not in finished):
        raise FileNotFoundError(f"no such version of {root}")
    schema, held = _manifest(spark, root, finished[-1] if version is None else version)
    return _read(spark, root, schema, held, partitions)


def _publish(spark: SparkSession, root: str, rows: DataFrame, kept: dict[tuple, int], partitions: Sequence[str], sort: Sequence[str]) -> int:
    """Write `rows` as the partitions of a new version, which also has the partitions `kept` of earlier ones."""
    used = _versions(spark, f"{root}/manifest") + _versions(spark, f"{root}/data")
    version = max(used, default=0) + 1
    target = f"{root}/data/{VERSION}={version}"
    _spread(rows, partitions, sort).write.option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(target)
    schema = rows.schema
    # partition values come from the folders, so only the files' footers are read
    written = spark.read.schema(schema).parquet(target).select(*partitions).distinct().collect()
    _switch(spark, root, version, schema, kept | {tuple(r): version for r in written})
    return version


def write_snapshot(df: DataFrame, root: str, partitions: Sequence[str] = PARTITIONS, sort: Sequence[str] = ()) -> int:
    """A new version that holds `df` and nothing else; returns its number."""
    return _publish(df.sparkSession, root, df, {}, partitions, sort)


def merge_snapshot(
    spark: SparkSession,
    root: str,
    current: DataFrame,
    recomputed: Sequence[tuple[str, str]] | None = None,
    sort: Sequence[str] = ("strategy", "epikey"),
) -> int:
    """Merge recomputed cohorts (all, if None) into the stored ones; returns the number of the current version afterwards.

    Only partitions with a row that is new, changed or gone are written again; if there is none, nothing is.
    """
    finished = finished_versions(spark, root)
    if not finished:
        return write_snapshot(current.select(*MERGE_KEY, "sample_rate"), root, PARTITIONS, sort)
    schema, held = _manifest(spark, root, finished[-1])
    stored = _read(spark, root, schema, held, PARTITIONS)
    delta = materialise(merge_cohorts(stored, current, recomputed).filter("action <> 'keep'"))
    touched = {tuple(r) for r in delta.select(*PARTITIONS).distinct().collect()}
    if not touched:
        return finished[-1]
    # of the table, only these partitions are read again
    old = _read(spark, root, schema, {p: v for p, v in held.items() if p in touched}, PARTITIONS)
    rest = old.join(delta.select(*MERGE_KEY), MERGE_KEY, "left_anti")
    rows = rest.select(*schema.names).unionByName(delta.filter("action <> 'delete'").select(*schema.names))
    return _publish(spark, root, rows, {p: v for p, v in held.items() if p not in touched}, PARTITIONS, sort)


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete what none of the last `keep` finished versions needs, also what unfinished ones left; returns the data versions deleted."""
    finished = finished_versions(spark, root)
    last = finished[-keep:]
    needed = {v for number in last for v in _manifest(spark, root, number)[1].values()}
    gone = [v for v in _versions(spark, f"{root}/data") if v not in needed]
    for kind, numbers in (("manifest", [v for v in _versions(spark, f"{root}/manifest") if v not in last]), ("data", gone)):
        for number in numbers:
            folder, files = _folder(spark, f"{root}/{kind}/{VERSION}={number}")
            files.delete(folder, True)
    return gone
