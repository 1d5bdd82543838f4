"""Joining per-group statistics back to the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def broadcast_if_bounded(stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Hint a broadcast where the group key itself bounds the row count.

    A single date key has few thousand values per decade however many rows
    are grouped under it.  Any other key could grow with the data, so its join
    gets no hint: AQE decides from the measured size and splits skewed groups.
    """
    dated = len(by) == 1 and isinstance(stats.schema[by[0]].dataType, T.DateType)
    return F.broadcast(stats) if dated else stats


def attach(
    df: DataFrame,
    stats: DataFrame,
    by: Sequence[str],
    *,
    within: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Join one row of ``stats`` per group; by default keeps every row of ``df``.

    ``within`` names further key columns that take a fixed few values in each
    group (a series number, a column name), so that ``stats`` is bounded
    whenever ``by`` is.  A NULL key is a group of its own, as in ``groupBy``.
    """
    keys = [*by, *within]
    right = broadcast_if_bounded(stats, by).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(right, same, how).drop(*[f"__{k}" for k in keys])
