"""Month-start calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.snapshots import as_date


def month_starts(start: str | dt.date, end: str | dt.date) -> list[dt.date]:
    """First of every month from the month of ``start`` up to ``end``, inclusive."""
    first, last = as_date(start), as_date(end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]


def calendar(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The same dates as a table."""
    return month_spine(
        spark.range(1).select(F.lit(as_date(start)).alias("start"), F.lit(as_date(end)).alias("end"))
    )


def month_spine(bounds: DataFrame) -> DataFrame:
    """Month starts between the columns ``start`` and ``end`` of a one-row table."""
    months = F.sequence(F.trunc("start", "MM"), F.col("end"), F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias(SNAPSHOT))
