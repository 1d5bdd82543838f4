"""Embedding whitening: principal components of a distributed covariance.

Entries become whole numbers, ``floor(64 c) + 1000000``.  One pass adds up their
exact sums per dimension, a second one the products of the exactly centred
entries: a task sends a matrix of a row per dimension, whatever its number of
vectors, and only the summed matrix comes to the driver, which finds its
eigenvectors by mixed-precision refinement (:mod:`eigen`).  A third pass
measures the covariance of the whitened values, a fourth one returns them.

Defined cases: vectors that are null, empty or hold null or non-finite entries,
or entries of ``2 ** 56`` or more, which leave the range of a long, are dropped;
vectors of each length are fitted by themselves; equal rows are as many vectors, and a null ``vec_id`` is one like
others; a component without variance (its eigenvalue is not above rounding)
has null whitened values and does not count in the identity error, which is
null if no component has variance; a deviation beyond 38 digits is null; other
columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import eigen
from ledgerloom.llm.arrow import map_arrow
from ledgerloom.llm.ship import ship

COMPONENTS = 32
LIMIT = 2.0**56
OFFSET, UNITS = 1_000_000, 64
SAFE = 1 << 62


@dataclass
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray | None = None  # eigenvalues, largest first
    vectors: np.ndarray | None = None  # a column per component
    trace: float = 0.0


def is_fit(vector: Column) -> Column:
    """Neither null nor empty nor with null, non-finite or too large entries."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LIMIT)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def codes(entries: np.ndarray) -> np.ndarray:
    return np.floor(entries * UNITS).astype(np.int64) + OFFSET


def deviations(x: np.ndarray, fit: Fit) -> np.ndarray:
    """``n x - S``, exactly: as int64 where that holds it, or as Python's integers."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if fit.n * most + max(map(abs, fit.sums), default=0) < SAFE:
        return fit.n * x - np.array(fit.sums, np.int64)
    return fit.n * x.astype(object) - np.array(fit.sums, object)


def squares(apart: np.ndarray) -> list[int]:
    """Sums of squares per row, exactly."""
    if apart.dtype != object:
        most = int(np.abs(apart).max(initial=0))
        if most * most * max(apart.shape[1], 1) < SAFE:
            return (apart * apart).sum(1).tolist()
        apart = apart.astype(object)
    return (apart * apart).sum(1).tolist()


def _by_length(batch: pa.RecordBatch):
    """Length, places and matrix of the vectors of each length in a batch."""
    column = batch.column("embedding")
    size = np.diff(column.offsets.to_numpy())
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(n), at, flat.astype(np.float64).reshape(len(at), int(n))


def _totals(rows: DataFrame) -> dict[int, Fit]:
    """Number and exact sums of the vectors of each length."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for size, at, entries in _by_length(batch):
                x = codes(entries)
                wide = x.size and max(abs(int(x.min())), abs(int(x.max()))) * len(x) >= SAFE
                added = (x.astype(object) if wide else x).sum(0).tolist()
                n, sums = held.get(size, (0, [0] * size))
                held[size] = [n + len(at), [a + b for a, b in zip(sums, added, strict=True)]]
        for size, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size], pa.int32()),
                    pa.array([n], pa.int64()),
                    pa.array([[Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0))),
                ],
                names=["size", "n", "sums"],
            )

    found = map_arrow(rows.select("embedding"), run, "size int, n long, sums array<decimal(38,0)>")
    added = found.select("size", "n", F.posexplode("sums").alias("at", "value")).groupBy("size", "at").agg(
        F.sum("n").alias("n"), F.sum("value").alias("value")
    )
    fits: dict[int, Fit] = {}
    for r in added.orderBy("size", "at").collect():  # a row per length and dimension
        fits.setdefault(r["size"], Fit(r["n"], [])).sums.append(int(r["value"]))
    return fits


def _products(rows: DataFrame, of: Callable[[int, np.ndarray], np.ndarray | None]) -> dict[int, np.ndarray]:
    """Per length, the sum of ``m' m`` over all rows ``m`` of the matrices that
    ``of`` makes, with their column sums as a last row.

    A task sends one row per column; the rows of a column are added in the order
    of the tasks.
    """

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, entries in _by_length(batch):
                m = of(size, codes(entries))
                if m is not None:
                    held[size] = held.get(size, 0.0) + np.vstack([m.T @ m, m.sum(0)])
        for size, total in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size] * len(total), pa.int32()),
                    pa.array(np.arange(len(total), dtype=np.int32)),
                    pa.array(total.tolist(), pa.list_(pa.float64())),
                ],
                names=["size", "at", "sums"],
            )

    def add(key, table):
        order = np.argsort(table["task"].to_numpy(), kind="stable")
        total = np.array(table["sums"].to_pylist())[order].sum(0)
        return pa.table(
            {
                "size": pa.array([key[0].as_py()], pa.int32()),
                "at": pa.array([key[1].as_py()], pa.int32()),
                "sums": pa.array([total.tolist()], pa.list_(pa.float64())),
            }
        )

    kind = "size int, at int, sums array<double>"
    sent = map_arrow(rows.select("embedding"), run, kind).withColumn("task", F.spark_partition_id())
    added = sent.groupBy("size", "at").applyInArrow(add, kind)
    out: dict[int, list] = {}
    for r in added.orderBy("size", "at").collect():  # a row per length and dimension
        out.setdefault(r["size"], []).append(r["sums"])
    return {size: np.array(sums) for size, sums in out.items()}


def valid_rows(vectors: DataFrame) -> DataFrame:
    own = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return own.where(is_fit(F.col("embedding")))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The components of the vectors of each length (runs two passes)."""
    rows = valid_rows(vectors)
    fits = _totals(rows)
    held = ship(rows.sparkSession).sparkContext.broadcast(fits)

    def centred(size, x):
        known = held.value.get(size)
        return None if known is None else (deviations(x, known) / known.n).astype(np.float64)

    for size, total in _products(rows, centred).items():
        one = fits[size]
        covariance = total[:-1] / one.n
        one.trace = float(np.trace(covariance))
        values, x = eigen.eigh((covariance + covariance.T) / 2)
        one.values, one.vectors = values[:components], x[:, :components]
    return fits


def _whitened(x: np.ndarray, one: Fit) -> np.ndarray:
    """A column per component; NaN where it has no variance."""
    centred = (deviations(x, one) / one.n).astype(np.float64)
    spread = np.sqrt(np.where(has_variance(one), one.values, np.nan))
    return centred @ one.vectors / spread


def has_variance(one: Fit) -> np.ndarray:
    return one.values > one.trace * len(one.sums) * 2.0**-52


def whiten(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``vec_id``, ``n``, ``deviation`` (decimal), ``whitened`` (a value per
    component), ``explained`` (each one's share of the variance) and
    ``identity_error`` of every row that has a fit."""
    rows, spark = valid_rows(vectors), vectors.sparkSession
    held = ship(spark).sparkContext.broadcast(fits)

    def some(size, x):
        one = held.value.get(size)
        if one is None or not has_variance(one).any():
            return None
        return _whitened(x, one)[:, has_variance(one)]

    errors = {}
    for size, total in _products(rows, some).items():
        mean = total[-1] / fits[size].n
        covariance = total[:-1] / fits[size].n - np.outer(mean, mean)
        errors[size] = float(np.abs(covariance - np.eye(len(covariance))).max())
    known = [
        (size, one.n, [float(v) / one.trace if one.trace else 0.0 for v in one.values], errors.get(size))
        for size, one in fits.items()
    ]

    def run(batches):
        for batch in batches:
            for size, at, entries in _by_length(batch):
                one = held.value.get(size)
                if one is None:
                    continue
                x = codes(entries)
                far = [Decimal(v) if v < 10**38 else None for v in squares(deviations(x, one))]
                white = _whitened(x, one)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(at) + 1, dtype=np.int32) * white.shape[1]),
                    pa.array(white.ravel(), from_pandas=True),  # NaN is null
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(at)),
                        pa.array([size] * len(at), pa.int32()),
                        pa.array(far, pa.decimal128(38, 0)),
                        listed,
                    ],
                    names=["vec_id", "size", "deviation", "whitened"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    made = map_arrow(rows, run, f"vec_id {kind}, size int, deviation decimal(38,0), whitened array<double>")
    about = spark.createDataFrame(known, "size int, n long, explained array<double>, identity_error double")
    # a row per length
    return made.join(F.broadcast(about), "size").select(
        "vec_id", "n", "deviation", "whitened", "explained", "identity_error"
    )
