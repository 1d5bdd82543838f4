"""Grouped quantiles of numeric columns.

A quantile is an element of the data; NULLs and NaNs are ignored.  ``q``
selects the smallest value whose cumulative share is at least ``q``, where
``q`` is the decimal number that is written (0.07 is 7 of 100).  Two ways:

* *sketch* - ``accuracy`` given: KLL sketches, rank error about 1/accuracy.
* *exact*, without keeping a group's values in one place: a first pass
  encloses the wanted rank between two values of a sketch, a second one counts
  the rows below them and each distinct value between them, for all columns at
  once, whatever their types.  That table, under one percent of the rows, is
  stored.  It is cut into cells, of which only the one that holds the rank is
  kept, until one is small enough to be summed up in order.  Columns that are
  known to have few values need no sketch: all their values are counted.

Sketches are merged in two levels, those of some map tasks first, so that no
task reads one sketch of every map task.  The first way is lazy; the second
runs its passes when called and stores what it finds in ``scratch``, which the
caller discards when the result is no longer read.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.operators.attach import attach
from ledgerloom.sources.scratch import Scratch

SUMMED = 100_000  # counted values of a group and series that one task puts in order
# Size of the brackets' sketches, whose rank error is about 0.0013.
_SKETCH = 4_096
# Half-widths of the bracket, as shares of the rows: well above the sketch's
# error, and wider ones should a sketch be worse than promised.
_MARGINS = (0.004, 0.04, 1.0)
_CELLS = 256
_LEAST_SKETCH, _LARGEST_SKETCH = 8, 65_535


def quantile_name(column: str, q: float) -> str:
    return f"{column}_p{q * 100:g}"


def group_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    by: Sequence[str],
    *,
    accuracy: int | None = None,
    scratch: Scratch | None = None,
    summed: int = SUMMED,
    few: Collection[str] = (),
) -> DataFrame:
    """One row per group with a column ``<name>_p<percent>`` per quantile.

    ``few`` names columns whose values are known to be few in a group, such as
    integers of a small range.  It changes the work, not the result.
    """
    by = list(by)
    series = [(name, q) for name, qs in wanted.items() for q in qs]
    slim = df.select(*by, *[_proper(df, name).alias(name) for name in wanted])
    if accuracy:
        sketches = _sketches(slim, list(wanted), by, sketch_size(accuracy))
        return sketches.select(
            *by,
            *[
                _quantiles(name, F.lit(float(q))).cast(df.schema[name].dataType).alias(quantile_name(name, q))
                for name, q in series
            ],
        )
    if scratch is None:
        raise ValueError("exact quantiles need a scratch folder, which the caller discards")
    enclosed = [name for name in wanted if name not in few]

    def search(margin: float) -> DataFrame | None:
        brackets = None
        if enclosed:
            found = _sketches(slim, enclosed, by, _SKETCH)
            ends = [_bracket(name, wanted[name], margin).alias(f"b_{name}") for name in enclosed]
            brackets = scratch.stage(found.select(*by, *ends), "brackets")
        return _select_exact(slim, series, brackets, by, scratch, summed)

    return next(found for found in map(search, _MARGINS) if found is not None)


def sketch_size(accuracy: int) -> int:
    """Size of a KLL sketch with half the rank error, as it is merged."""
    size = math.ceil((2 * 2.296 * accuracy) ** (1 / 0.9021))
    if size > _LARGEST_SKETCH:
        raise ValueError(f"no sketch has a rank error of 1/{accuracy}; leave accuracy out for exact quantiles")
    return max(size, _LEAST_SKETCH)


def _sketches(df: DataFrame, names: Sequence[str], by: Sequence[str], size: int) -> DataFrame:
    """Per group ``k_<name>``, a KLL sketch of the column as doubles, and ``n_<name>``,
    the number of its values.

    The salt is the map task's number modulo the shuffle partitions: with as many
    map tasks as the square of these, both levels merge equally many sketches.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy(*by, "__salt").agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"k_{c}") for c in names],
        *[F.count(c).alias(f"n_{c}") for c in names],
    )
    return first.groupBy(*by).agg(
        *[F.kll_merge_agg_double(F.col(f"k_{c}"), F.lit(size)).alias(f"k_{c}") for c in names],
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in names],
    )


def _quantiles(name: str, ranks: Column) -> Column:
    """Values of the sketch ``k_<name>``; NULL where it is empty."""
    return F.when(F.col(f"n_{name}") > 0, F.kll_sketch_get_quantile_double(F.col(f"k_{name}"), ranks))


def _proper(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def _rank(count: Column, q: float) -> Column:
    """``count * q`` rounded up, at least 1, with the decimal that ``q`` is written as."""
    share = Decimal(repr(q))
    exact = count.cast("decimal(18,0)") * F.lit(share)
    return F.greatest(F.ceil(exact).cast("long"), F.lit(1).cast("long"))


def _bracket(name: str, qs: Sequence[float], margin: float) -> Column:
    """The number of values, and for each quantile two values that enclose it.

    Sketches hold doubles, so whatever is compared with one is cast first: the
    order of the values survives that, and the results are not cast.
    """
    ends = [end for q in qs for end in (max(q - margin, 0.0), min(q + margin, 1.0))]
    return F.struct(
        F.col(f"n_{name}").alias("count"), _quantiles(name, F.array(*[F.lit(e) for e in ends])).alias("ends")
    )


def _select_exact(
    slim: DataFrame,
    series: list[tuple[str, float]],
    brackets: DataFrame | None,
    by: list[str],
    scratch: Scratch,
    summed: int,
) -> DataFrame | None:
    """The result, or None if a bracket does not hold its rank.

    The values of all series are one column per type, of which a row fills one:
    they are counted and put in order in one pass, and longs and decimals never
    become doubles.
    """
    types: list[T.DataType] = []
    for name, _ in series:
        if slim.schema[name].dataType not in types:
            types.append(slim.schema[name].dataType)
    values = [f"v{t}" for t in range(len(types))]
    enclosed = [] if brackets is None else [c.removeprefix("b_") for c in brackets.columns if c not in by]

    def entry(number: int, name: str | None, q: float = 0.0) -> Column:
        at = [other for column, other in series if column == name]
        rank = low = high = F.lit(None)
        if name in enclosed:
            bracket = F.col(f"b_{name}")
            rank = _rank(bracket["count"], q)
            low, high = (bracket["ends"][2 * at.index(q) + end] for end in (0, 1))
        own = None if name is None else slim.schema[name].dataType
        return F.struct(
            F.lit(number).alias("series"),
            rank.cast("long").alias("rank"),
            low.cast("double").alias("lo"),
            high.cast("double").alias("hi"),
            *[
                (F.col(name) if kind == own else F.lit(None)).cast(kind).alias(value)
                for kind, value in zip(types, values, strict=True)
            ],
        )

    # Count the rows below the bracket (values NULL) and each value inside it.
    # Map-side combine leaves one row per task for "below" and for any value
    # that many rows share.  Series -1 are the groups' rows.
    entries = [entry(i, name, q) for i, (name, q) in enumerate(series)] + [entry(-1, None)]
    raw = F.coalesce(*[F.col(v).cast("double") for v in values])
    inside = F.col("lo").isNull() | (raw >= F.col("lo"))
    counts = scratch.stage(
        (slim if brackets is None else attach(slim, brackets, by))
        .select(*by, F.explode(F.array(*entries)).alias("e"))
        .select(*by, "e.*")
        .where((F.col("series") < 0) | (raw.isNotNull() & (F.col("hi").isNull() | (raw <= F.col("hi")))))
        .select(*by, "series", "rank", *[F.when(inside, F.col(v)).alias(v) for v in values])
        .groupBy(*by, "series", "rank", *values)
        .agg(F.count(F.lit(1)).alias("n")),
        "bracket-counts",
    )
    groups = counts.where("series < 0").select(*by)
    ready = counts.where("series >= 0")
    if brackets is None or len(enclosed) < len({name for name, _ in series}):
        ready = _ranked(ready, series, by)
    ready = ready.withColumn("before", F.lit(0).cast("long"))
    if brackets is not None:
        ready = _narrowed(counts, ready, values, by, scratch, summed)
    if ready is None:
        return None
    within = ["series", "rank"]
    along = Window.partitionBy(*by, *within).rowsBetween(Window.unboundedPreceding, 0)
    # below the bracket comes first: NULLs do
    found = ready.withColumn("upto", F.col("before") + F.sum("n").over(along.orderBy(*values))).where(_holds_rank())
    picked = []
    for i, (name, q) in enumerate(series):
        value = F.col(values[types.index(slim.schema[name].dataType)])
        picked.append(F.max(F.when(F.col("series") == i, value)).alias(quantile_name(name, q)))
    return attach(groups, found.groupBy(*by).agg(*picked), by)


def _ranked(counts: DataFrame, series: list[tuple[str, float]], by: list[str]) -> DataFrame:
    """Ranks of the series without a bracket, from the number of their values."""
    totals = counts.where("rank IS NULL").groupBy(*by, "series").agg(F.sum("n").alias("total"))
    rank = reduce(
        lambda rest, i: F.when(F.col("series") == i, _rank(F.col("total"), series[i][1])).otherwise(rest),
        range(len(series)),
        F.lit(None).cast("long"),
    )
    return attach(counts, totals, by, within=["series"]).withColumn("rank", F.coalesce("rank", rank)).drop("total")


def _narrowed(
    counts: DataFrame, ready: DataFrame, values: list[str], by: list[str], scratch: Scratch, summed: int
) -> DataFrame | None:
    """``ready``, cut until no group and series has over ``summed`` values; None if a
    bracket missed its rank."""
    within = ["series", "rank"]
    is_below = reduce(lambda a, b: a & b, [F.col(v).isNull() for v in values])
    below = F.sum(F.when(is_below, F.col("n")).otherwise(0))
    widest, missed = (
        counts.where("series >= 0")
        .groupBy(*by, *within)
        .agg(F.count(F.lit(1)).alias("rows"), below.alias("below"), F.sum("n").alias("upto"))
        .agg(
            F.coalesce(F.max("rows"), F.lit(0)),
            F.count_if((F.col("below") >= F.col("rank")) | (F.col("upto") < F.col("rank"))),
        )
        .first()
    )
    if missed:
        return None
    while widest > summed:
        ready = scratch.stage(_cell_of_rank(ready, by, within, values), "cells")
        held = ready.groupBy(*by, *within).agg(F.count(F.lit(1)).alias("rows"))
        before, widest = widest, held.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
        if widest == before:  # values that no double tells apart
            break
    return ready


def _cell_of_rank(counts: DataFrame, by: list[str], within: list[str], values: list[str]) -> DataFrame:
    """The counted values of the cell that holds the rank, and the rows before it.

    ``before`` rows were cut off below ``counts`` already.
    """
    coded = counts.withColumn("x", F.coalesce(*[F.col(v).cast("double") for v in values]))
    ranks = F.array(*[F.lit(i / _CELLS) for i in range(1, _CELLS)])
    cuts = _sketches(coded, ["x"], [*by, *within], _SKETCH).select(*by, *within, _quantiles("x", ranks).alias("cuts"))
    celled = attach(coded, cuts, by, within=within).withColumn(
        "cell",
        F.when(F.col("x").isNull(), F.lit(-1)).otherwise(F.size(F.filter("cuts", lambda cut: cut < F.col("x")))),
    )
    along = Window.partitionBy(*by, *within).rowsBetween(Window.unboundedPreceding, 0)
    # At most 257 totals per group and series.
    chosen = (
        celled.groupBy(*by, *within, "cell", "before")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.col("before") + F.sum("n").over(along.orderBy("cell")))
        .where(_holds_rank())
        .select(*by, *within, F.col("cell").alias("hit"), (F.col("upto") - F.col("n")).alias("start"))
    )
    kept = attach(celled, chosen, by, within=within, how="inner").where(F.col("cell") == F.col("hit"))
    return kept.select(*by, *within, *values, "n", F.col("start").alias("before"))


def _holds_rank() -> Column:
    return (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))

