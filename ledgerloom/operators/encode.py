"""Categorical encoding with one vocabulary per column and snapshot.

Fitting counts the values of all columns in one pass and numbers them by
descending frequency, ties by value.  The vocabulary is a stored table, never a
list on the driver or in one task: it is numbered by one range-partitioned
sort.

Encoding meets the vocabulary once, whatever the number of columns: the
combinations of values that occur, each once and long values as digests, are
looked up column by column in one join of these narrow codes, and the rows then
meet the combinations, in one join too.  Spark knows the stored tables' bytes, so it broadcasts small ones and
shuffles large ones, where adaptive execution splits hot values.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.operators.attach import attach
from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.scratch import Scratch

@dataclass(frozen=True)
class Levels:
    """A fitted vocabulary: one row per group, column and value."""

    table: DataFrame  # *by, column, value, count, level, stored by column
    columns: tuple[str, ...]
    by: tuple[str, ...]


def count_levels(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (SNAPSHOT,)) -> DataFrame:
    """Frequency of every non-NULL value, per group and column.

    Partial aggregation runs before the shuffle, so a value held by a third of
    all rows still sends one row per task.
    """
    return (
        df.select(*by, F.explode(_pairs(columns)).alias("pair"))
        .select(*by, "pair.*")
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def count_tuples(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (SNAPSHOT,)) -> DataFrame:
    """How often every combination of values (NULL is one) occurs, per group."""
    return df.groupBy(*by, *columns).agg(F.count(F.lit(1)).alias("count"))


def levels_of_tuples(tuples: DataFrame, by: Sequence[str] = (SNAPSHOT,)) -> DataFrame:
    """:func:`count_levels` from the combinations' counts."""
    columns = [c for c in tuples.columns if c not in (*by, "count")]
    return (
        tuples.select(*by, "count", F.explode(_pairs(columns)).alias("pair"))
        .select(*by, "count", "pair.*")
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value")
        .agg(F.sum("count").alias("count"))
    )


def _pairs(columns: Sequence[str]) -> Column:
    """Column names and their values as text."""
    return F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )


def rank_levels(counts: DataFrame, by: Sequence[str], scratch: Scratch) -> DataFrame:
    """Number the levels 0, 1, ... without collecting a vocabulary in one task.

    One global sort, written out with row ids so that its partitioning is
    fixed; a row's position is the size of the partitions before its own plus
    its offset, and its level the distance to the first row of its column.
    """
    ordered = scratch.stage(
        counts.orderBy(*by, "column", F.desc("count"), "value").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "sorted-levels",
    ).withColumns(
        {"part": F.shiftright("row", 33), "offset": F.col("row").bitwiseAND((1 << 33) - 1)}
    )
    # One row per partition of the sort: bounded by the shuffle partition count.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy("part")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    placed = ordered.join(F.broadcast(parts), "part").withColumn(
        "position", F.col("start") + F.col("offset")
    )
    # stored, so that Spark knows how small it is before it lays out the join
    firsts = scratch.stage(
        placed.groupBy(*by, "column").agg(F.min("position").alias("first")), "first-levels"
    )
    return attach(placed, firsts, by, within=["column"]).select(
        *by, "column", "value", "count", (F.col("position") - F.col("first")).cast("int").alias("level")
    )


def fit_levels(
    df: DataFrame, columns: Sequence[str], scratch: Scratch, by: Sequence[str] = (SNAPSHOT,)
) -> Levels:
    """Count and number the levels of ``columns`` (runs a job, like any fit)."""
    return number_levels(count_levels(df, columns, by), columns, scratch, by)


def number_levels(
    counts: DataFrame, columns: Sequence[str], scratch: Scratch, by: Sequence[str] = (SNAPSHOT,)
) -> Levels:
    """The vocabularies that ``counts`` (as of :func:`count_levels`) describe."""
    table = scratch.stage(rank_levels(counts, by, scratch), "levels", directory_by="column")
    return Levels(table, tuple(columns), tuple(by))


def frozen(levels: Levels, group: object, groups: Sequence[object]) -> Levels:
    """The vocabularies of one ``group`` for each of ``groups``.

    For fitting on a training window and encoding what comes later alike:
    groups are snapshots, as many as the calendar has.
    """
    (name,) = levels.by
    one = levels.table.where(F.col(name) == F.lit(group)).drop(name)
    return Levels(
        one.withColumn(name, F.explode(F.array(*[F.lit(g) for g in groups]))), levels.columns, levels.by
    )


def look_up(tuples: DataFrame, levels: Levels) -> DataFrame:
    """The groups and combinations of values in ``tuples``, which are distinct, with
    ``__<column>`` = {size, slot} for each of their columns.

    ``size`` is the number of levels in the group, ``slot`` the value's level, or
    NULL where it has none.
    """
    own = [c for c in levels.columns if c in tuples.columns]
    known = levels.table.where(F.col("column").isin(own)).select(
        *[F.col(k).alias(f"__{k}") for k in levels.by],
        F.col("column").alias("__column"),
        F.col("value").alias("__value"),
        F.col("level").alias("__level"),
    )
    same = (F.col("column") == F.col("__column")) & (F.col("value") == F.col("__value"))
    for k in levels.by:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    codes = tuples.select(*levels.by, *own, F.explode(_pairs(own)).alias("pair")).select("*", "pair.*")
    slots = (
        codes.join(known, same, "left")
        .groupBy(*levels.by, *own)
        .agg(*[F.expr(f"max(__level) FILTER (WHERE column = '{c}') AS `__{c}_slot`") for c in own])
    )
    sizes = levels.table.groupBy(*levels.by).agg(
        *[F.count_if(F.col("column") == c).cast("int").alias(f"__{c}_n") for c in own]
    )
    return attach(slots, sizes, levels.by).select(
        *levels.by,
        *own,
        *[F.expr(f"struct(coalesce(`__{c}_n`, 0) AS size, `__{c}_slot` AS slot) AS `__{c}`") for c in own],
    )


def index_columns(df: DataFrame, levels: Levels, *, tuples: Sequence[DataFrame] = ()) -> DataFrame:
    """Add ``<column>_index``: the level of the value in its group.

    NULL and values outside the vocabulary get the extra last index, which is
    the number of levels.  ``tuples`` are tables of :func:`look_up` that together
    hold all columns; by default they are made from ``df``.
    """
    indexes = [F.expr(f"coalesce(`__{c}`.slot, `__{c}`.size) AS `{c}_index`") for c in levels.columns]
    return _looked_up(df, levels, tuples).select(*df.columns, *indexes)


def one_hot_columns(
    df: DataFrame,
    levels: Levels,
    *,
    alongside: DataFrame | None = None,
    tuples: Sequence[DataFrame] = (),
) -> DataFrame:
    """Replace each categorical column by its one-hot vector ``<column>_ohe``.

    A vector is stored as ``{size, slot}``: its length and the position of the
    one, NULL for the all-zero vector of NULL and unseen values.  Its width in
    storage does not grow with the vocabulary; :func:`dense` spells it out.

    ``alongside`` are further statistics, a row for every group, whose columns
    are added.  ``tuples`` are as in :func:`index_columns`.
    """
    kept = [c for c in df.columns if c not in levels.columns]
    vectors = [F.col(f"__{c}").alias(f"{c}_ohe") for c in levels.columns]
    out = _looked_up(df, levels, tuples)
    added = []
    if alongside is not None:
        out, added = attach(out, alongside, levels.by), [c for c in alongside.columns if c not in levels.by]
    return out.select(*kept, *vectors, *added)


def with_vectors(df: DataFrame, columns: Sequence[str], scratch: Scratch) -> DataFrame:
    """``df``, stored, with its ``{size, slot}`` columns as sparse ML vectors; nothing is
    as wide as the vocabulary.

    Built-in functions make ML vectors from dense arrays only.  A stored vector is
    a struct, though: the columns are written as such structs and read back under
    the vector type, which costs no conversion at all.
    """
    parts = {}
    for c in columns:
        size, slot = F.col(c)["size"], F.col(c)["slot"]
        some = slot.isNotNull()
        parts[c] = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            size.alias("size"),
            F.when(some, F.array(slot)).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
        )
    stored = scratch.path(f"vectors-{uuid.uuid4().hex}")
    df.withColumns(parts).write.parquet(stored)
    schema = T.StructType(
        [T.StructField(f.name, VectorUDT()) if f.name in columns else f for f in df.schema]
    )
    return scratch.spark.read.schema(schema).parquet(stored)


def dense(vector: Column) -> Column:
    """A one-hot vector as ``array<double>``, as wide as its vocabulary."""
    zeros = F.array_repeat(F.lit(0.0), vector["size"])
    return F.when(vector["slot"].isNull(), zeros).otherwise(
        F.transform(zeros, lambda zero, i: F.when(i == vector["slot"], F.lit(1.0)).otherwise(zero))
    )


def _looked_up(df: DataFrame, levels: Levels, tuples: Sequence[DataFrame]) -> DataFrame:
    """``df`` with ``__<column>`` = {size, slot}; a join per table of combinations.

    Without ``tuples`` the combinations are those of ``df``, of short codes instead
    of long values: only codes are shuffled for the look-up, and long values not at
    all, unless the result has them.
    """
    names, out = {}, df
    if not tuples:
        names = {c: f"__code_{c}" for c in levels.columns}
        out = df.withColumns({code: _code(F.col(c).cast("string")) for c, code in names.items()})
        found = out.select(*levels.by, *[F.col(code).alias(c) for c, code in names.items()]).distinct()
        table = levels.table.withColumn("value", _code(F.col("value")))
        tuples = [look_up(found, Levels(table, levels.columns, levels.by))]
    for table in tuples:
        keys = [c for c in table.columns if c in (*levels.by, *levels.columns)]
        right = table.withColumnsRenamed({k: f"__key_{k}" for k in keys})
        same = reduce(
            lambda a, b: a & b, [F.col(names.get(k, k)).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
        )
        out = out.join(right, same, "left").drop(*[f"__key_{k}" for k in keys])
    return out.drop(*names.values())


def _code(value: Column) -> Column:
    """The text itself, or its SHA-256 where that is shorter; two texts never share one."""
    digest = F.concat(F.lit("#"), F.sha2(value, 256))
    return F.when(F.octet_length(value) < 64, F.concat(F.lit("="), value)).otherwise(digest)
