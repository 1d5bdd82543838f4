"""What the rows of a feature join are like, without joining them.

Every table is summed up once, per key (and date, or category values): row
counts, counts of complete rows, and limits of the numeric columns.  Such rows
can be added up in any order, and those of joined rows are products, least and
greatest values of them.  One stored profile therefore answers which keys are
hot, which categories occur how often, the limits for scaling, and how many
rows are dropped as incomplete; no table is read again for any of these.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import CUSTOMER, SNAPSHOT
from ledgerloom.sources.jobs import side_by_side
from ledgerloom.sources.scratch import Scratch


def profile_rows(df: DataFrame, keys: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Per group ``rows``, ``complete`` and the limits ``<column>_min``, ``_max`` of
    complete rows, which have no NULL and no NaN in ``numeric``.

    Rows are combined before the shuffle, so a key that a third of all rows have
    sends one row per task.  A greatest value that equals the least one is stored
    as NULL, which takes no space where groups are single rows.  Whether a row is
    complete is found out once, before it is added up: spelt out in each limit it
    made methods that Java does not compile.
    """
    tests = []
    for c in numeric:
        tests.append(f"`{c}` IS NOT NULL")
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            tests.append(f"NOT isnan(`{c}`)")
    complete = " AND ".join(tests) or "true"
    marked = df.select(*keys, *numeric, F.expr(complete).alias("__complete"))
    masked = marked.select(
        *keys,
        "__complete",
        *[F.expr(f"CASE WHEN __complete THEN CAST(`{c}` AS DOUBLE) END AS `__x_{c}`") for c in numeric],
    )
    limits = []
    for c in numeric:
        low, high = f"min(`__x_{c}`)", f"max(`__x_{c}`)"
        limits += [F.expr(f"{low} AS `{c}_min`"), F.expr(f"nullif({high}, {low}) AS `{c}_max`")]
    return masked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__complete")).alias("complete"), *limits
    )


def merged(profiles: DataFrame, keys: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Profiles of finer groups added up."""
    limits = []
    for c in numeric:
        limits.append(F.expr(f"min(`{c}_min`) AS `{c}_min`"))
        limits.append(F.expr(f"max(coalesce(`{c}_max`, `{c}_min`)) AS `{c}_max`"))
    return profiles.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sum("complete").alias("complete"), *limits)


@dataclass(frozen=True)
class JoinProfile:
    """Stored profiles of a driving table, per key and date, and of the side
    tables, per key and category values."""

    rows: DataFrame
    sides: tuple[DataFrame, ...]
    categories: tuple[tuple[str, ...], ...]  # of each side
    numeric: tuple[tuple[str, ...], ...]  # of the driving table and of each side
    key: str
    when: str

    def _counts(self, side: int) -> DataFrame:
        return self.sides[side].groupBy(self.key).agg(F.sum("rows").alias(f"rows_{side + 1}"))

    def _product(self, name: str) -> Column:
        return reduce(lambda a, b: a * b, [F.col(f"{name}_{i}") for i in range(len(self.sides) + 1)])

    def key_counts(self) -> DataFrame:
        """Keys that all tables hold, as of :func:`~ledgerloom.operators.joins.key_counts`."""
        out = self.rows.groupBy(self.key).agg(F.sum("rows").alias("rows_0"))
        for i in range(len(self.sides)):
            out = out.join(self._counts(i), self.key)
        return out.withColumn("joined", self._product("rows").cast("double"))

    def totals(self) -> DataFrame:
        """Per date the joined rows, those of them that are complete (``kept``), and
        the limits of the latter.

        A joined row is complete where all its parts are, so a part's limits
        count where the key has complete rows in all tables.
        """
        parts = [self.rows] + [
            merged(side, [self.key], numeric)
            for side, numeric in zip(self.sides, self.numeric[1:], strict=True)
        ]
        met = reduce(
            lambda a, b: a.join(b, self.key),
            [p.withColumnsRenamed({"rows": f"rows_{i}", "complete": f"complete_{i}"}) for i, p in enumerate(parts)],
        ).withColumns({"joined": self._product("rows"), "kept": self._product("complete")})
        limits = []
        for i, names in enumerate(self.numeric):
            for c in names:
                high = f"coalesce(`{c}_max`, `{c}_min`)" if i == 0 else f"`{c}_max`"
                limits.append(F.expr(f"min(`{c}_min`) FILTER (WHERE kept > 0) AS `{c}_min`"))
                limits.append(F.expr(f"max({high}) FILTER (WHERE kept > 0) AS `{c}_max`"))
        return met.groupBy(self.when).agg(F.sum("joined").alias("joined"), F.sum("kept").alias("kept"), *limits)

    def tuples(self, side: int) -> DataFrame:
        """Per date and combination of a side's categories, the joined rows that have
        it (``count``): the sum of products of row counts."""
        out = self.rows.select(self.key, self.when, F.col("rows").alias("rows_0"))
        for other in range(len(self.sides)):
            if other != side:
                out = out.join(self._counts(other), self.key)
        own = self.sides[side].select(self.key, *self.categories[side], F.col("rows").alias(f"rows_{side + 1}"))
        return (
            out.join(own, self.key)
            .groupBy(self.when, *self.categories[side])
            .agg(F.sum(self._product("rows")).alias("count"))
        )


def profile_join(
    rows: DataFrame,
    sides: Sequence[DataFrame],
    scratch: Scratch,
    *,
    numeric: Sequence[str],
    categories: Sequence[str],
    key: str = CUSTOMER,
    when: str = SNAPSHOT,
) -> JoinProfile:
    """Read every table once and store its profile; the tables are independent."""

    def own(df: DataFrame, names: Sequence[str]) -> tuple[str, ...]:
        return tuple(c for c in names if c in df.columns)

    values = [own(df, numeric) for df in (rows, *sides)]
    levels = [own(side, categories) for side in sides]
    jobs = {"rows": lambda: scratch.stage(profile_rows(rows, [key, when], values[0]), "profile-rows")}
    for i, side in enumerate(sides):
        jobs[f"side-{i}"] = lambda i=i, side=side: scratch.stage(
            profile_rows(side, [key, *levels[i]], values[i + 1]), f"profile-side-{i}"
        )
    stored = side_by_side(scratch.spark, jobs)
    return JoinProfile(
        stored["rows"], tuple(stored[f"side-{i}"] for i in range(len(sides))), tuple(levels), tuple(values), key, when
    )
