"""Connected components of a table of links, by alternating stars.

Each round first links every node's larger neighbours to its least neighbour,
then its smaller ones; rounds end when no link changes, which leaves a star
per component.  A hub's links are never gathered: the least neighbour is an
aggregate with partial sums, joined back to the links, and Spark splits a hub's
part of that join.  Every round is a written table, so no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import Scratch


def _print_of(links: DataFrame) -> tuple:
    """Number of links and an order-free hash of them."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("big", "small")).alias("x"),
        F.sum(F.xxhash64("small", "big").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node to the least of it and its neighbours."""
    both = links.select(F.col("big").alias("node"), F.col("small").alias("other")).unionAll(
        links.select(F.col("small").alias("node"), F.col("big").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.where("other > node")
        .join(least, "node")
        .select(F.col("other").alias("big"), F.least("node", "least").alias("small"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, to the least of them."""
    least = links.groupBy("big").agg(F.min("small").alias("least"))
    moved = (
        links.join(least, "big")
        .where("small > least")
        .select(F.col("small").alias("big"), F.col("least").alias("small"))
    )
    return moved.unionAll(least.select("big", F.col("least").alias("small"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root``, the least node that is reachable, for nodes that
    have a link.  ``links`` has two columns of one orderable type; direction,
    repetition, loops and nulls do not matter.
    """
    a, b = links.columns
    links = (
        links.where(f"`{a}` <> `{b}`")
        .select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
        .distinct()
    )
    links = scratch.stage(links, "links")
    seen = _print_of(links)
    while seen[0]:
        links = scratch.stage(_small_star(scratch.stage(_large_star(links), "large")), "small")
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("small").alias("node"), F.col("small").alias("root")).distinct()
    return links.select(F.col("big").alias("node"), F.col("small").alias("root")).unionAll(roots)
