"""Snapshot and bundle commits: readers never see a drop that isn't whole."""
import datetime as dt
import os

import pytest

from strata.session import scratch_path
from strata.sources import commits
from strata.sources import files as S

A, B, C = dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 2, 4)


def drop(spark, v):
    return spark.createDataFrame([(v,)], "v int").coalesce(1)


def values(df):
    return sorted(r.v for r in df.collect())


def part(folder):
    return next(os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-"))


def local(root):
    return root.removeprefix("file://").removeprefix("file:")


def test_half_written_newest_drop_is_not_read(spark):
    root = scratch_path(spark, "commits")
    for v, d in enumerate((A, B), 1):
        S.write_snapshot(drop(spark, v), root, d.isoformat())
    drop(spark, 9).write.parquet(f"{root}/{S.SNAP}={C}")  # written, but not committed
    assert S.snapshot_dates(spark, root) == [A, B] and values(S.read_latest(spark, root)) == [2]
    assert values(S.read_snapshots(spark, root)) == [1, 2] and values(S.read_month_end_snapshots(spark, root)) == [2]
    S.write_snapshot(drop(spark, 3), root, C.isoformat())  # the job runs again
    assert values(S.read_latest(spark, root)) == [3] and values(S.read_month_end_snapshots(spark, root)) == [2, 3]


def test_broken_replacement_falls_back(spark):
    """A committed drop of which a file is gone or cut is not read until it is committed again."""
    root = scratch_path(spark, "broken")
    S.write_snapshot(drop(spark, 1), root, A.isoformat())
    S.write_snapshot(drop(spark, 2), root, B.isoformat())
    with open(part(f"{local(root)}/{S.SNAP}={B}"), "r+b") as f:
        f.truncate(10)
    assert values(S.read_latest(spark, root)) == [1] and S.snapshot_dates(spark, root) == [A]
    S.write_snapshot(drop(spark, 5), root, B.isoformat())
    assert values(S.read_latest(spark, root)) == [5] and values(S.read_snapshots(spark, root)) == [1, 5]


def test_write_that_fails_leaves_the_old_drop(spark, monkeypatch):
    root = scratch_path(spark, "fails")
    S.write_snapshot(drop(spark, 1), root, A.isoformat())

    def broken(*_):
        raise OSError("store is gone")

    monkeypatch.setattr(commits, "replace", broken)
    with pytest.raises(OSError):
        S.write_snapshot(drop(spark, 2), root, A.isoformat())
    assert values(S.read_snapshots(spark, root)) == [1]


def test_one_entry_for_all_drops_of_a_write(spark):
    root = scratch_path(spark, "entry")
    S.write_snapshot(spark.createDataFrame([(1, A), (2, B), (3, C)], "v int, snapshot_date date"), root)
    S.write_snapshot(spark.createDataFrame([(4, B)], "v int, snapshot_date date"), root)
    assert len([n for n in commits.entries(spark, f"{root}/{commits.LOG}") if n.endswith(".json")]) == 2
    assert values(S.read_snapshots(spark, root)) == [1, 3, 4]


def test_folders_without_a_log_are_read_as_they_are(spark):
    root = scratch_path(spark, "foreign")
    drop(spark, 1).write.parquet(f"{root}/{S.SNAP}={A}")
    assert S.snapshot_dates(spark, root) == [A] and values(S.read_latest(spark, root)) == [1]


def test_bundle_is_read_whole_or_not_at_all(spark):
    path = scratch_path(spark, "bundle")
    drop(spark, 1).write.parquet(f"{path}/table=one")
    with pytest.raises(FileNotFoundError):
        S.read_bundle(spark, path)
    S.write_bundle(path, {"one": drop(spark, 1), "two": drop(spark, 2)})
    assert sorted((r.table, r.v) for r in S.read_bundle(spark, path).collect()) == [("one", 1), ("two", 2)]
    os.remove(part(f"{local(path)}/table=two"))
    with pytest.raises(FileNotFoundError):
        S.read_bundle(spark, path)
