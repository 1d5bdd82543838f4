"""Tables of a directory per snapshot: slice, write in one step, read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.scratch import COMPRESSION
from ledgerloom.sources.versions import NO_DATE, RUN, VersionedTable


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def snapshot_slice(
    df: DataFrame,
    dates: Sequence[str | dt.date],
    *,
    snapshot: str = SNAPSHOT,
    undated: str = "error",
) -> DataFrame:
    """Rows of the given snapshots.

    ``undated`` says what to do with a table that has no snapshot column:
    ``"error"``, or ``"replicate"`` to put the whole table into every snapshot.
    """
    days = [as_date(d) for d in dates]
    if snapshot in df.columns:
        return df.where(F.col(snapshot).isin(days))
    if undated == "replicate":
        return df.withColumn(snapshot, F.explode(F.array(*[F.lit(d) for d in days])))
    raise ValueError(f"table has no column {snapshot!r}; pass undated='replicate' to copy it")


def write_snapshots(
    df: DataFrame,
    path: str,
    *,
    dates: Sequence[str | dt.date] | None = None,
    snapshot: str = SNAPSHOT,
    clustered: bool = False,
) -> None:
    """Overwrite just the snapshots present in ``df`` (and those in ``dates``), in one
    step: readers see all of the table as it was, or all of it as it will be.

    The rows go to a new directory beside the stored ones; then the table's next
    version, which names a directory per snapshot, takes effect by the renaming of
    one file (:mod:`~ledgerloom.sources.versions`).  A driver that is lost before
    has changed nothing, and one lost after it has only left files to remove.

    Rows of all snapshots usually sit mixed in every task, which would write
    one small file per task and snapshot.  The rebalance hint regroups them by
    snapshot and, unlike a plain repartition, lets AQE cut a large snapshot
    into several evenly sized tasks.  ``clustered=True`` skips that shuffle for
    input that was read from, and still is in, snapshot order.
    """
    spark = df.sparkSession
    if not clustered and spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("regrouping by snapshot needs spark.sql.adaptive.enabled")
    table = VersionedTable(spark, path, snapshot)
    out = df if clustered else df.hint("rebalance", F.col(snapshot))
    run = table.new_run()
    out.write.option("compression", COMPRESSION).partitionBy(snapshot).parquet(f"{path.rstrip('/')}/{run}")
    emptied = {as_date(d).isoformat() for d in dates or ()}
    body = T.StructType([f for f in df.schema if f.name != snapshot] + [df.schema[snapshot]])
    table.publish(run, emptied, body)
    table.remove_superseded()


def snapshot_directories(
    spark: SparkSession, path: str, snapshot: str = SNAPSHOT
) -> dict[dt.date, str]:
    """The stored snapshots and their directories; reads no data."""
    stored = VersionedTable(spark, path, snapshot).current().directories
    return {
        as_date(day): f"{path.rstrip('/')}/{directory}" for day, directory in stored.items() if day != NO_DATE
    }


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    dates: Sequence[str | dt.date] | None = None,
    snapshot: str = SNAPSHOT,
) -> DataFrame:
    """Read some or all snapshots of the table's current version; ``dates`` prunes
    directories, not rows."""
    version = VersionedTable(spark, path, snapshot).current()
    wanted = None if dates is None else {as_date(d).isoformat() for d in dates}
    chosen = [d for day, d in sorted(version.directories.items()) if wanted is None or day in wanted]
    schema = schema or version.schema
    if version.number == 0:  # not written by this library
        df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    elif not chosen:
        df = spark.createDataFrame([], schema)
    else:
        root = path.rstrip("/")
        parts = []
        for inside in (True, False):
            some = [f"{root}/{d}" for d in chosen if d.startswith(RUN) == inside]
            if some:
                parts.append(spark.read.schema(schema).option("basePath", root).parquet(*some).select(*schema.names))
        df = reduce(DataFrame.unionByName, parts)
    if wanted is None:
        return df
    return df.where(F.col(snapshot).isin([as_date(d) for d in dates]))


def legacy_path(
    folder: str, table: str, day: str | dt.date, suffix: str = "parquet", separator: str = "_"
) -> str:
    """File of one snapshot in the older one-file-per-month naming.

    Feature stores of that layout have no ``separator`` before the date.
    """
    return f"{folder.rstrip('/')}/{table}{separator}{as_date(day):%Y_%m_%d}.{suffix}"


def read_legacy_snapshots(
    spark: SparkSession,
    folder: str,
    table: str,
    *,
    dates: Sequence[str | dt.date] | None = None,
    separator: str = "_",
    suffix: str = "parquet",
) -> DataFrame:
    """Read files named ``<table>_YYYY_MM_DD.<suffix>``, all or some.

    CSV slices are read as text, by their header; conform them afterwards.
    """
    if dates is None:
        paths = [f"{folder.rstrip('/')}/{table}{separator}*.{suffix}"]
    else:
        paths = [legacy_path(folder, table, d, suffix, separator) for d in dates]
    if suffix == "csv":
        return spark.read.option("header", True).csv(paths)
    return spark.read.parquet(*paths)
