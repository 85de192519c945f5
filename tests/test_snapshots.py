"""Snapshot merges: what is written, what is read, and what a crash leaves."""

import os

import pytest

from cohortlake.sources import snapshots

SCHEMA = "fyear int, provider string, epikey long, type string, strategy string, sample_rate double"


def rows(df):
    return sorted(tuple(r) for r in df.select("fyear", "provider", "epikey", "strategy", "sample_rate").collect())


def held(root, version):
    """Partitions that a version has written."""
    base = f"{root}/data/version={version}"
    return {os.path.relpath(d, base) for d, _, files in os.walk(base) if any(f.endswith(".parquet") for f in files) and d != base}


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "cohorts")
    first = [(2020, "P", 1, "e", "a", 1.0), (2020, "P", 2, "e", "b", 1.0), (2020, "Q", 3, "e", "a", 1.0), (2021, "P", 4, "e", "a", 0.5)]
    assert snapshots.merge_snapshot(spark, path, spark.createDataFrame(first, SCHEMA)) == 1
    return path


def test_only_changed_partitions_are_written(spark, root):
    current = spark.createDataFrame([(2020, "P", 1, "e", "a", 1.0), (2020, "Q", 3, "e", "a", 0.25), (2021, "R", 9, "e", "a", 1.0)], SCHEMA)
    assert snapshots.merge_snapshot(spark, root, current, [("e", "a")]) == 2
    # 2021/P lost its only row; 2020/P is as before and is not written again
    assert held(root, 2) == {"fyear=2020/provider=Q", "fyear=2021/provider=R"}
    want = [(2020, "P", 1, "a", 1.0), (2020, "P", 2, "b", 1.0), (2020, "Q", 3, "a", 0.25), (2021, "R", 9, "a", 1.0)]
    assert rows(snapshots.read_snapshot(spark, root)) == want
    assert len(rows(snapshots.read_snapshot(spark, root, 1))) == 4
    # again: nothing changes, no version is made
    assert snapshots.merge_snapshot(spark, root, current, [("e", "a")]) == 2
    # a full run without any row empties the table, which keeps its schema
    assert snapshots.merge_snapshot(spark, root, current.limit(0)) == 3
    empty = snapshots.read_snapshot(spark, root)
    assert empty.count() == 0 and empty.columns == snapshots.read_snapshot(spark, root, 1).columns


def test_a_crash_before_the_switch_leaves_the_old_state(spark, root, monkeypatch):
    before = rows(snapshots.read_snapshot(spark, root))
    changed = spark.createDataFrame([(2020, "Q", 3, "e", "a", 0.75)], SCHEMA)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_switch", crash)
        with pytest.raises(RuntimeError):
            snapshots.merge_snapshot(spark, root, changed, [("e", "a")])
    assert held(root, 2) and rows(snapshots.read_snapshot(spark, root)) == before
    # a manifest without its marker doesn't count either
    os.makedirs(f"{root}/manifest/version=3")
    assert rows(snapshots.read_snapshot(spark, root)) == before
    assert snapshots.merge_snapshot(spark, root, changed, [("e", "a")]) == 4
    assert rows(snapshots.read_snapshot(spark, root)) == [(2020, "P", 2, "b", 1.0), (2020, "Q", 3, "a", 0.75)]
    # what no kept version needs goes, also what the crash left
    assert snapshots.expire_snapshots(spark, root, keep=1) == [1, 2]
    assert snapshots.finished_versions(spark, root) == [4]
    assert rows(snapshots.read_snapshot(spark, root)) == [(2020, "P", 2, "b", 1.0), (2020, "Q", 3, "a", 0.75)]


def test_missing_versions(spark, root, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root, 7)
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, str(tmp_path / "nothing"))
