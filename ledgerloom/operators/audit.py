"""Row counts per snapshot and missing snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import SNAPSHOT


def row_counts(df: DataFrame, snapshot: str = SNAPSHOT) -> DataFrame:
    return df.groupBy(snapshot).agg(F.count(F.lit(1)).alias("rows"))


def snapshot_coverage(calendar: DataFrame, df: DataFrame, snapshot: str = SNAPSHOT) -> DataFrame:
    """Every date of the calendar with its row count, 0 where it is missing."""
    return calendar.join(row_counts(df, snapshot), snapshot, "left").select(
        snapshot, F.coalesce("rows", F.lit(0)).alias("rows")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without NULL that several rows share, and how many do."""
    return (
        df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )
