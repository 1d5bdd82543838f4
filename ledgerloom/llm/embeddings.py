"""Embedding near-duplicates: exact cosine links by cover trees over Spark.

Equal vectors are one node.  The trees' upper part is laid out by Spark: every
node goes to the cell of its nearest pivot, a cell is cut into bands by the
distance to the pivot, a large band into blocks by hash.  Two blocks are
compared only if the triangle inequality lets them hold a pair; each such pair
of blocks is one group of at most about ``2 * BLOCK`` rows, in which two trees
are traversed (:mod:`cover_tree`).  Groups give links per row, counted without
listing pairs, and a forest of what is linked, from which components follow.

Pivots are chosen from a sample of ``SAMPLE`` vectors and are ``PIVOTS`` per
dimension at most; they, and the distances' quantiles per cell, are all that
the driver sees.  The choice of pivots changes the work, not the result.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and are their own component; vectors of different
dimensions do not link; equal rows are as many vectors; a null ``vec_id`` is
never the least of a component; other columns are ignored, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrow import map_arrow
from ledgerloom.llm.components import components
from ledgerloom.llm.cover_tree import SLACK, threshold_links
from ledgerloom.sources.scratch import Scratch

COSINE = 0.95
BLOCK = 12_288
PIVOTS = 128
SAMPLE = 2_048
GRID = 64


def is_valid(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) > 0) & finite & some, F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _rows(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def pivots_of(sample: list[list[float]], most: int) -> dict[int, np.ndarray]:
    """Per dimension, vectors chosen one by one, each farthest from those before."""
    by_size: dict[int, list] = {}
    for vector in sample:
        by_size.setdefault(len(vector), []).append(vector)
    out = {}
    for size, rows in by_size.items():
        vectors = unit(np.array(rows, np.float64))
        chosen, near = [0], vectors @ vectors[0]
        while len(chosen) < min(most, len(vectors)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, vectors @ vectors[chosen[-1]])
        out[size] = vectors[chosen]
    return out


def _placed(nodes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``size``, ``cell`` (the nearest pivot) and the distance to it."""
    held = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            size = np.diff(column.offsets.to_numpy())
            cell, apart = np.zeros(len(size), np.int32), np.zeros(len(size))
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                # a dimension the sample has not seen is one cell around the
                # first axis
                centers = held.value.get(int(n), np.eye(1, int(n)))
                vectors = unit(_rows(column.take(pa.array(at))))
                cosine = vectors @ centers.T
                cell[at] = cosine.argmax(1)
                best = vectors - centers[cell[at]]
                apart[at] = np.linalg.norm(best, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    column,
                    batch.column("copies"),
                    pa.array(size.astype(np.int32)),
                    pa.array(cell),
                    pa.array(apart),
                ],
                names=["node", "embedding", "copies", "size", "cell", "apart"],
            )

    return map_arrow(
        nodes.select("node", "embedding", "copies"),
        run,
        "node long, embedding array<double>, copies long, size int, cell int, apart double",
    )


def _cell_pairs(pivots: dict[int, np.ndarray], stats: list, reach: float) -> list[tuple]:
    """Cells whose covering balls come within reach: (size, cell, other, distance)."""
    out = []
    for a in stats:
        for b in stats:
            if a["size"] != b["size"] or a["cell"] > b["cell"]:
                continue
            centers = pivots.get(a["size"], np.eye(1, a["size"]))
            between = float(np.linalg.norm(centers[a["cell"]] - centers[b["cell"]]))
            if between <= reach + a["most"] + b["most"] + SLACK:
                out.append((a["size"], a["cell"], b["cell"], between))
    return out


def _block_pairs(blocks: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """Pairs of blocks that may hold a pair of rows within reach.

    A row at distance ``d`` of its pivot is at least ``between - d`` and at most
    ``between + d`` from the other's.
    """
    a = blocks.select("size", *[F.col(c).alias(f"a_{c}") for c in ("cell", "block", "low", "high")])
    b = blocks.select("size", *[F.col(c).alias(f"b_{c}") for c in ("cell", "block", "low", "high")])
    limit = reach + 2 * SLACK
    cells = cells.select("size", F.col("cell").alias("a_cell"), F.col("other").alias("b_cell"), "between")
    return (
        cells.join(a, ["size", "a_cell"])
        .join(b, ["size", "b_cell"])
        .where((F.col("a_cell") < F.col("b_cell")) | (F.col("a_block") <= F.col("b_block")))
        .where(F.col("between") - F.col("a_high") - F.col("b_high") <= limit)
        .where(F.col("a_low") - F.col("between") - F.col("b_high") <= limit)
        .where(F.col("b_low") - F.col("between") - F.col("a_high") <= limit)
        .select("a_block", "b_block")
    )


def _compared(rows: DataFrame, cosine: float) -> DataFrame:
    """Per pair of blocks and linked node: links there, and the least linked node."""

    def run(key, table):
        table = table.combine_chunks()
        first, last = key[0].as_py(), key[1].as_py()
        # the order of rows must not depend on how they were shuffled
        block, node = table["block"].to_numpy(), table["node"].to_numpy()
        order = np.lexsort((node, block != first))
        vectors = unit(_rows(table["embedding"].chunk(0)))[order]
        node = node[order]
        split = int((block == first).sum()) if first != last else len(node)
        links = threshold_links(vectors, split, table["copies"].to_numpy()[order], cosine)
        at = np.flatnonzero(links.count)
        least = np.array([links.root(int(i)) for i in at], np.int64)
        return pa.table(
            {
                "node": pa.array(node[at], pa.int64()),
                "links": pa.array(links.count[at], pa.int64()),
                "to": pa.array(node[least], pa.int64()),
            }
        )

    return rows.groupBy("a_block", "b_block").applyInArrow(run, "node long, links long, to long")


def near_duplicates(
    vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark, reach = vectors.sparkSession, float(np.sqrt(2 - 2 * cosine))
    own = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), own.alias("embedding"))
    valid = rows.where(is_valid(F.col("embedding")))
    nodes = valid.groupBy("embedding").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    # the written ids stay as they are, however often the table is read
    nodes = scratch.stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()
    some = nodes.select("embedding").orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE)
    sample = [r["embedding"] for r in some.collect()]  # SAMPLE rows at most
    pivots = pivots_of(sample, max(1, min(PIVOTS, total // block)))
    placed = scratch.stage(_placed(nodes, pivots), "placed")

    steps = [i / GRID for i in range(1, GRID)]
    stats = (
        placed.groupBy("size", "cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("apart").alias("most"),
            F.percentile_approx("apart", steps, 1000).alias("grid"),
        )
        .collect()  # PIVOTS rows per dimension at most
    )
    edges = []
    for s in stats:
        bands = min(GRID, -(-s["n"] // block))
        cuts = [s["grid"][GRID * i // bands - 1] for i in range(1, bands)]
        edges.append((s["size"], s["cell"], sorted(set(cuts))))
    kind = "size int, cell int, cuts array<double>"
    banded = placed.join(F.broadcast(spark.createDataFrame(edges, kind)), ["size", "cell"])
    banded = banded.withColumn("band", F.size(F.filter("cuts", lambda c: c < F.col("apart"))))
    counted = banded.groupBy("size", "cell", "band").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / block).cast("int")
    # bands per cell are GRID at most
    sized = banded.join(
        F.broadcast(counted.select("size", "cell", "band", parts.alias("parts"))), ["size", "cell", "band"]
    )
    hashed = F.pmod(F.xxhash64("node"), F.col("parts"))
    name = F.concat_ws(".", "size", "cell", "band", hashed)
    blocked = sized.select("node", "embedding", "copies", "size", "cell", "apart", name.alias("block"))
    blocks = scratch.stage(
        blocked.groupBy("size", "cell", "block").agg(F.min("apart").alias("low"), F.max("apart").alias("high")),
        "blocks",
    )
    cells = spark.createDataFrame(
        _cell_pairs(pivots, stats, reach), "size int, cell int, other int, between double"
    )
    pairs = scratch.stage(_block_pairs(blocks, cells, reach), "pairs")
    ends = pairs.select("a_block", "b_block", F.explode(F.array_distinct(F.array("a_block", "b_block"))).alias("block"))
    work = blocked.select("node", "embedding", "copies", "block").join(ends, "block")
    found = scratch.stage(_compared(work, cosine), "found")

    roots = components(found.select("node", "to"), scratch)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        nodes.join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(counts, "node", "left")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    single = rows.where(~is_valid(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = valid.join(named, "embedding").select("vec_id", "n_links", "component_id")
    return linked.unionAll(single).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
