"""Helpers for Arrow-batch functions: work in slices of bounded size."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.ship import ship

SLICE_BYTES = 1 << 20


def release() -> None:
    """Give memory that is free back to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` whose function may use this package on any executor."""
    ship(df.sparkSession)

    def bounded(batches):
        yield from run(batches)
        release()

    return df.mapInArrow(bounded, schema)


def adding(df: DataFrame, run, added: dict[str, T.DataType]) -> DataFrame:
    """``df`` with the columns that ``run`` adds, replacing equal names."""
    kept = [f for f in df.schema if f.name not in added]
    return map_arrow(df, run, T.StructType(kept + [T.StructField(n, t) for n, t in added.items()]))


def slices(batches, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most`` bytes in each.

    A single longer text is a slice of its own; nothing is cut inside a row.
    """
    for batch in batches:
        offset, start, held = 0, 0, 0
        for value in pc.binary_length(batch.column(column)).to_pylist():
            held += value or 0
            offset += 1
            if held >= most:
                yield batch.slice(start, offset - start)
                start, held = offset, 0
        if start < batch.num_rows:
            yield batch.slice(start)
        release()


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with ``added`` columns after its own, replacing equal names."""
    kept = [n for n in batch.schema.names if n not in added]
    arrays = [batch.column(n) for n in kept] + list(added.values())
    return pa.RecordBatch.from_arrays(arrays, names=kept + list(added))


def int_lists(values, lengths) -> pa.ListArray:
    """A list column from the concatenated ``values`` and each list's length."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
