"""Assembling and min-max scaling numeric features per snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.attach import attach
from ledgerloom.schemas import SNAPSHOT


def skip_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of ``columns``."""
    return df.na.drop(subset=list(columns))


def assemble(columns: Sequence[str]) -> Column:
    """The columns as one ``array<double>``."""
    return F.expr(f"array({', '.join(_double(c) for c in columns)})")


def fit_min_max(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (SNAPSHOT,)
) -> DataFrame:
    """``<column>_min`` and ``<column>_max`` per group, all columns in one pass."""
    return df.groupBy(*by).agg(
        *[F.expr(f"min({_double(c)}) AS `{c}_min`") for c in columns],
        *[F.expr(f"max({_double(c)}) AS `{c}_max`") for c in columns],
    )


def assemble_scaled(columns: Sequence[str]) -> Column:
    """The scaled columns as one array; needs the limits' columns beside them."""
    return F.expr(f"array({', '.join(_min_max(c) for c in columns)})")


def scale_min_max(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (SNAPSHOT,),
    *,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Add ``<column>_scaled``; ``limits`` defaults to a fit on ``df`` itself."""
    fitted = fit_min_max(df, columns, by) if limits is None else limits
    return (
        attach(df, fitted, by)
        .withColumns({f"{c}_scaled": F.expr(_min_max(c)) for c in columns})
        .drop(*fitted.drop(*by).columns)
    )


def _double(column: str) -> str:
    return f"CAST(`{column}` AS DOUBLE)"


def _min_max(column: str) -> str:
    """``column`` scaled to [0, 1], 0.5 where it is constant, as SQL."""
    x, lo, hi = _double(column), f"`{column}_min`", f"`{column}_max`"
    return f"CASE WHEN {hi} > {lo} THEN ({x} - {lo}) / ({hi} - {lo}) WHEN {x} IS NOT NULL THEN 0.5D END"
