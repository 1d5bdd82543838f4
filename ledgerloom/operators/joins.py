"""Feature join: one driving table, several side tables, one shared key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.schemas import CUSTOMER, SNAPSHOT


def key_counts(tables: Sequence[DataFrame], key: str = CUSTOMER) -> DataFrame:
    """Keys that all ``tables`` hold: ``rows_0, rows_1, ...`` and ``joined``, the
    rows that they give together.  Counts are combined before the shuffle."""
    counts = [
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(f"rows_{i}"))
        for i, df in enumerate(tables)
    ]
    product = reduce(lambda a, b: a * b, [F.col(f"rows_{i}").cast("double") for i in range(len(tables))])
    return reduce(lambda a, b: a.join(b, key), counts).withColumn("joined", product)


def hot_keys(counts: DataFrame, key: str = CUSTOMER, *, pieces: int | None = None) -> DataFrame:
    """Keys with a piece's share of the join's result or more, and their salts.

    ``counts`` is :func:`key_counts`, stored, as it is read twice.  A piece is
    one of ``pieces`` equal shares of all joined rows (default: the number of
    shuffle partitions), so ``pieces`` keys qualify at most, whatever the
    size.  A key is cut into as many combinations of salts as it has shares:
    its longest table first, the others where that has too few rows.
    """
    pieces = pieces or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables = sorted(c for c in counts.columns if c.startswith("rows_"))
    total = counts.agg(F.sum("joined")).first()[0] or 0.0
    share = F.lit(total / pieces)
    hot = counts.where((F.col("joined") >= share) & (F.col("joined") > 1)).withColumn(
        "left", F.ceil(F.col("joined") / share)
    )
    # longest first; the position tells equal counts apart
    order = F.sort_array(
        F.array(*[F.struct(F.col(c).alias("n"), F.lit(i).alias("i")) for i, c in enumerate(tables)]), False
    )
    hot = hot.withColumn("order", order)
    for place in range(len(tables)):
        n = F.col("order")[place]["n"]
        hot = hot.withColumn(f"cut_{place}", F.least("left", n)).withColumn(
            "left", F.ceil(F.col("left") / F.col(f"cut_{place}"))
        )
    salts = [
        reduce(
            lambda rest, place: F.when(F.col("order")[place]["i"] == i, F.col(f"cut_{place}")).otherwise(rest),
            range(len(tables)),
            F.lit(1),
        ).cast("int").alias(f"salts_{i}")
        for i in range(len(tables))
    ]
    return hot.select(key, *salts)


def feature_join(
    rows: DataFrame,
    sides: Sequence[DataFrame],
    key: str = CUSTOMER,
    *,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``rows`` with every side table on ``key``.

    All joins share the key, so each table is shuffled once.  Small sides are
    broadcast by Spark from their measured size, not by a hint.

    ``hot`` is a :func:`hot_keys` table.  Each table's rows of a hot key are
    spread over its salts and repeated for the other tables' salts, so that
    every combination meets exactly once, in the task of its salts; other keys
    keep the salts 0.  The tables must then be read from files, whose row order
    is stable, so that a repeated task assigns the same salts.
    """
    tables = [rows, *sides]
    salts = [f"__salt{i}" for i in range(len(tables))] if hot is not None else []
    if salts:
        tables = [_salt(df, i, key, hot, salts) for i, df in enumerate(tables)]
    out = tables[0]
    for side in tables[1:]:
        out = out.join(side, [key, *salts])
    return out.drop(*salts)


def _salt(df: DataFrame, own: int, key: str, hot: DataFrame, salts: Sequence[str]) -> DataFrame:
    """Add a salt column per table; the own one first, before rows repeat."""
    # as many rows as pieces of the join at most
    df = df.join(F.broadcast(hot), key, "left")
    count = [F.coalesce(f"salts_{i}", F.lit(1)) for i in range(len(salts))]
    df = df.withColumn(salts[own], F.pmod(F.monotonically_increasing_id(), count[own]).cast("int"))
    for i, salt in enumerate(salts):
        if i != own:
            df = df.withColumn(salt, F.explode(F.sequence(F.lit(0), count[i] - 1)))
    return df.drop(*[f"salts_{i}" for i in range(len(salts))])


def as_of_join(
    rows: DataFrame,
    sides: Sequence[DataFrame],
    key: str = CUSTOMER,
    when: str = SNAPSHOT,
    *,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Each of ``rows`` with the latest row of every side not after its ``when``.

    Rows without one in some side, without key or without date are left out.  Rows
    and dated side rows are laid out in the order of their dates, once for all
    sides, and each row takes the last side rows before it: no key's side rows are
    gathered, and no row multiplies.

    ``hot`` is a :func:`hot_keys` table of ``rows`` alone.  A hot key's rows are
    spread over its salts, and its side rows, one per date, repeated for each.
    The tables must then be read from files, whose row order is stable, so that a
    repeated task assigns the same salts.
    """
    parts = [rows.where(F.col(key).isNotNull() & F.col(when).isNotNull())] + [
        latest_per_date(side, key, when) for side in sides
    ]
    kept = [[c for c in df.columns if c not in (key, when)] for df in parts]
    if hot is not None:
        # as many rows as pieces of the table at most
        salts = F.broadcast(hot.select(key, F.col("salts_0").alias("__salts")))
        parts = [df.join(salts, key, "left") for df in parts]
        count = F.coalesce("__salts", F.lit(1))
        own = F.pmod(F.monotonically_increasing_id(), count).cast("int")
        parts = [parts[0].withColumn("__salt", own)] + [
            df.withColumn("__salt", F.explode(F.sequence(F.lit(0), count - 1))) for df in parts[1:]
        ]
    else:
        parts = [df.withColumn("__salt", F.lit(0)) for df in parts]
    kinds = [T.StructType([df.schema[c] for c in names]) for df, names in zip(parts, kept, strict=True)]

    def laid_out(i: int) -> DataFrame:
        held = [
            (F.struct(*kept[i]) if j == i else F.lit(None)).cast(kind).alias(f"__{j}") for j, kind in enumerate(kinds)
        ]
        # a side row of the same date comes before the rows
        return parts[i].select(key, when, "__salt", F.lit(int(i == 0)).alias("__last"), *held)

    before = (
        Window.partitionBy(key, "__salt").orderBy(when, "__last").rowsBetween(Window.unboundedPreceding, 0)
    )
    lines = reduce(DataFrame.unionByName, [laid_out(i) for i in range(len(parts))])
    found = [f"__{j}" for j in range(1, len(parts))]
    out = lines.select(key, when, "__last", "__0", *[F.last(c, ignorenulls=True).over(before).alias(c) for c in found])
    out = out.where(F.col("__last") == 1)
    for c in found:
        out = out.where(F.col(c).isNotNull())
    columns = [F.col(c) if c in (key, when) else F.col(f"__0.{c}").alias(c) for c in rows.columns]
    return out.select(
        *columns, *[F.col(f"__{j}.{c}").alias(c) for j in range(1, len(parts)) for c in kept[j]]
    )


def latest_per_date(side: DataFrame, key: str, when: str) -> DataFrame:
    """One row per key and date: of several, the greatest in column order."""
    kept = [c for c in side.columns if c not in (key, when)]
    return (
        side.where(F.col(when).isNotNull())
        .groupBy(key, when)
        .agg(F.max(F.struct(*kept)).alias("__one"))
        .select(key, when, "__one.*")
    )
