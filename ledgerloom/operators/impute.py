"""Imputation and outlier replacement from statistics of the own snapshot."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.attach import attach
from ledgerloom.operators.quantiles import group_quantiles, quantile_name
from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.scratch import Scratch

MEDIAN, P99 = 0.5, 0.99


def with_imputation(
    df: DataFrame,
    *,
    medians: Sequence[str] = (),
    outliers: Mapping[str, str] | None = None,
    q: float = P99,
    by: Sequence[str] = (SNAPSHOT,),
    accuracy: int | None = None,
    scratch: Scratch | None = None,
    few: Collection[str] = (),
) -> DataFrame:
    """Both rules below from one set of statistics and one join.

    ``medians`` lists columns whose NULLs become the median of their group;
    ``outliers`` maps a column to the column whose median replaces its values
    above quantile ``q``.  The other arguments are those of
    :func:`~ledgerloom.operators.quantiles.group_quantiles`.
    """
    outliers = outliers or {}
    wanted: dict[str, list[float]] = {}

    def want(name: str, quantile: float) -> Column:
        qs = wanted.setdefault(name, [])
        if quantile not in qs:
            qs.append(quantile)
        return F.col(f"__{quantile_name(name, quantile)}")

    changed = {}
    for name in medians:
        fill = want(name, MEDIAN).try_cast(df.schema[name].dataType)
        changed[name] = F.coalesce(F.col(name), fill)
    for name, source in outliers.items():
        fill = want(source, MEDIAN).try_cast(df.schema[name].dataType)
        changed[name] = F.when(F.col(name) > want(name, q), fill).otherwise(F.col(name))

    stats = group_quantiles(df, wanted, by, accuracy=accuracy, scratch=scratch, few=few)
    stats = stats.select(*by, *[F.col(c).alias(f"__{c}") for c in stats.columns if c not in by])
    return attach(df, stats, by).select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns]
    )


def fill_median(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """NULLs become the median of the group; a group of NULLs stays NULL."""
    return with_imputation(df, medians=columns, **options)


def replace_above_quantile(df: DataFrame, columns: Mapping[str, str], **options) -> DataFrame:
    """Values strictly above the group's quantile become a group median."""
    return with_imputation(df, outliers=columns, **options)


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULLs of the named columns become the given constants."""
    return df.na.fill(dict(values))


def fill_all_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """NULLs (and NaNs) of every numeric column become ``value``."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.na.fill(value, subset=numeric) if numeric else df
