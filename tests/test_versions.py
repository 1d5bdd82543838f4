"""Publishing in one step: whatever is lost, readers see the old or the new table."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import versions
from ledgerloom.sources.snapshots import read_snapshots, snapshot_directories, write_snapshots
from ledgerloom.sources.versions import VersionedTable

JAN, FEB, MAR = (dt.date(2023, m, 1) for m in (1, 2, 3))


class DriverLost(Exception):
    pass


def table(spark, rows):
    return spark.createDataFrame(rows, "x int, snapshot_date date")


def rows_of(spark, path, **options):
    return sorted(map(tuple, read_snapshots(spark, path, **options).collect()), key=repr)


OLD = [(1, JAN), (2, FEB), (3, MAR)]
CHANGE = [(20, FEB), (21, FEB)]
NEW = [(1, JAN), (20, FEB), (21, FEB)]


def lose(*_args):
    raise DriverLost


@pytest.mark.parametrize(
    "step, expected",
    [("publish", OLD), ("_renamed", OLD), ("remove_superseded", NEW)],
)
def test_a_lost_driver_leaves_the_old_or_the_new_table(spark, scratch, monkeypatch, step, expected):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, step, lose)
        with pytest.raises(DriverLost):
            write_snapshots(table(spark, CHANGE), path, dates=[FEB, MAR])
    assert rows_of(spark, path) == sorted(expected, key=repr)
    assert rows_of(spark, path, dates=[FEB]) == sorted([r for r in expected if r[1] == FEB], key=repr)
    write_snapshots(table(spark, CHANGE), path, dates=[FEB, MAR])  # the repeated run
    assert rows_of(spark, path) == sorted(NEW, key=repr)
    assert set(snapshot_directories(spark, path)) == {JAN, FEB}


def test_a_lost_write_is_not_seen(spark, scratch):
    """The write itself stops half way: some of its files are there."""
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    broken = table(spark, CHANGE).withColumn("x", F.when(F.col("x") == 21, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        write_snapshots(broken, path, dates=[FEB])
    assert rows_of(spark, path) == OLD


def test_readers_keep_the_version_that_they_opened(spark, scratch):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    opened = read_snapshots(spark, path)
    write_snapshots(table(spark, CHANGE), path, dates=[FEB, MAR])
    assert sorted(map(tuple, opened.collect())) == OLD


def test_superseded_directories_are_removed(spark, scratch):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    for x in range(5):
        write_snapshots(table(spark, [(x, FEB)]), path)
    stored = VersionedTable(spark, path, "snapshot_date")
    assert len(stored._numbers()) == versions.KEPT
    runs = [n for n in stored._listed() if n.startswith(versions.RUN)]
    assert len(runs) == 1 + versions.KEPT  # the first one still holds January and March
    assert rows_of(spark, path) == [(1, JAN), (3, MAR), (4, FEB)]


def test_another_writer_in_between(spark, scratch, monkeypatch):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    renamed, met = VersionedTable._renamed, []

    def later(self, version):
        if not met:
            met.append(version.number)
            write_snapshots(table(spark, [(10, JAN)]), path)
        return renamed(self, version)

    monkeypatch.setattr(VersionedTable, "_renamed", later)
    write_snapshots(table(spark, [(30, MAR)]), path)
    assert rows_of(spark, path) == [(10, JAN), (2, FEB), (30, MAR)]


def test_runs_in_progress_are_not_removed(spark, scratch, monkeypatch):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    stored = VersionedTable(spark, path, "snapshot_date")
    run = stored.new_run()
    table(spark, [(9, JAN)]).write.partitionBy("snapshot_date").parquet(f"{path}/{run}")
    write_snapshots(table(spark, CHANGE), path)
    assert run in stored._listed()
    monkeypatch.setattr(versions, "ABANDONED_DAYS", -1)
    stored.remove_superseded()
    assert run not in stored._listed()
    assert rows_of(spark, path) == [(1, JAN), (20, FEB), (21, FEB), (3, MAR)]


def test_a_folder_of_plain_directories_is_taken_over(spark, scratch):
    path = scratch.path("t")
    table(spark, [*OLD, (7, None)]).write.partitionBy("snapshot_date").parquet(path)
    assert len(rows_of(spark, path)) == 4
    write_snapshots(table(spark, CHANGE), path, dates=[FEB, MAR])
    assert rows_of(spark, path) == sorted([*NEW, (7, None)], key=repr)
    assert set(snapshot_directories(spark, path)) == {JAN, FEB}


def test_columns_of_the_last_write(spark, scratch):
    path = scratch.path("t")
    write_snapshots(table(spark, OLD), path)
    more = spark.createDataFrame([(5, 0.5, FEB)], "x int, y double, snapshot_date date")
    write_snapshots(more, path)
    assert rows_of(spark, path) == [(1, None, JAN), (3, None, MAR), (5, 0.5, FEB)]
    assert read_snapshots(spark, path, dates=["2030-01-01"]).dtypes == more.dtypes
