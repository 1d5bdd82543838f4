"""Mixing sources to target weights by the cube method.

A source's target is its weight's share of all words, but not more than ``MOST``
times its own; the excess is shared again.  Every document is taken as often as
its source's target holds the source whole, and once more with the rest as its
probability.  These rests are rounded by the cube method (:mod:`cube`): words and
documents of a source stay balanced in every step.

* Documents that make up a ``HEADS``-th of their source or more are settled
  first, one group per source.  All others make up for them: their probability
  changes by a line in their size, for which their number, sum, squares and
  largest size are enough.
* The others are settled in groups of about ``CHUNK`` by hash, two of a group at
  most stay open, and these are grouped again until one group per source is left,
  which lands.

Groups and random numbers follow from the documents' ids, sizes and text hashes
alone, so that reruns agree however the rows lie.  Equal rows are one unit with a
count, so no group holds their number.

Defined cases: a null text has size 0, and so has one without words; a null
source is one of its own, the last; a null id is a value like others; equal rows
are as many documents, of which any may be the ones that are taken more often; a
source without words has target 0 and is not taken; other columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm import cube
from ledgerloom.llm.ship import ship
from ledgerloom.sources.scratch import Scratch

WEIGHTS = (1, 2, 3)
MOST = 3
HEADS = 1024
CHUNK = 512
PIECE = 100_000
SEED = 42


def size_of(text: Column) -> Column:
    """Number of words: runs of other than ASCII white space, without listing them."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    )


def targets(units: DataFrame, scratch: Scratch) -> DataFrame:
    """``source``, ``n``, ``source_size``, ``weight`` and ``target`` of ``units``,
    rows with a count ``m``, stored.

    Sources may be many: they are numbered by a range-partitioned sort, and the
    words per weight are found by rounds of sums, each of which finds the sources
    that their own size stops.
    """
    found = units.groupBy("source").agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.col("size")).alias("source_size")
    )
    ordered = scratch.stage(
        found.orderBy(F.asc_nulls_last("source")).withColumn("row", F.monotonically_increasing_id()), "ordered"
    ).withColumns({"part": F.shiftright("row", 33), "offset": F.col("row").bitwiseAND((1 << 33) - 1)})
    # one row per partition of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy("part")
        .agg(F.count(F.lit(1)).alias("held"))
        .select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    )
    place = (F.col("start") + F.col("offset")) % len(WEIGHTS)
    weighted = scratch.stage(
        ordered.join(F.broadcast(parts), "part").select(
            "source",
            "n",
            "source_size",
            F.element_at(F.lit(list(WEIGHTS)), (place + 1).cast("int")).alias("weight"),
            (F.col("source_size") * MOST).alias("most"),
        ),
        "weighted",
    )
    level = 0.0
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        total, stopped, weight = weighted.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not weight or (total - (stopped or 0)) / weight <= level:
            break
        level = (total - (stopped or 0)) / weight
    return scratch.stage(
        weighted.withColumn("target", F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))),
        "targets",
    )


def _with(rows: DataFrame, about: DataFrame) -> DataFrame:
    """Columns of ``about``, a row per source; null is a source."""
    right = about.withColumnRenamed("source", "__source")
    return rows.join(right, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


COLUMNS = ["source", "doc_id", "text_hash", "size", "spot", "m"]


def _generator(level: int, key) -> np.random.Generator:
    """Random numbers that follow from the group's names alone."""
    source = key[0].as_py()
    named = [0] if source is None else [1, zlib.crc32(source.encode())]
    return np.random.default_rng([SEED, level, *named, *[k.as_py() for k in key[1:]]])


def _ordered(table):
    """The rows, largest first, in an order that does not depend on the shuffle."""
    size = table["size"].to_numpy().astype(np.float64)
    order = np.lexsort((table["spot"].to_numpy(), -size))
    return table.take(pa.array(order)), size[order]


def _type(rows: DataFrame) -> str:
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return f"source string, doc_id {id_type}, text_hash long, size long, spot long, m long, extra long, open double"


def _settled_heads(rows: DataFrame) -> DataFrame:
    """Per source, its large units with ``extra``, copies beyond the whole ones, and
    ``open``, what is not settled; ``base`` and ``slope`` give the new probability
    of the source's other units."""
    ship(rows.sparkSession)

    def run(key, table):
        table, size = _ordered(table)
        first = {c: float(table[c][0].as_py() or 0) for c in ("share", "tail_n", "tail_sum", "tail_squares", "tail_most")}
        share = first.pop("share")
        # the rows of a unit one by one: no more than HEADS in all
        unit = np.repeat(np.arange(len(size)), table["m"].to_numpy())
        shares, tail = cube.certain(size[unit], share, cube.Tail(*first.values()))
        shares, tail = cube.settle(size[unit], shares, _generator(0, key), tail=tail)
        taken = np.bincount(unit, shares == 1, len(size)).astype(np.int64)
        left = np.bincount(unit, np.where(shares < 1, shares, 0), len(size))
        out = table.select(COLUMNS).append_column("extra", pa.array(taken))
        out = out.append_column("open", pa.array(left, mask=left == 0))
        for name, value in (("base", tail.share), ("slope", tail.slope)):
            out = out.append_column(name, pa.array(np.full(len(size), value)))
        return out

    return rows.groupBy("source").applyInArrow(run, _type(rows) + ", base double, slope double")


def _settled(rows: DataFrame, level: int, *, land: bool = False) -> DataFrame:
    """Units of each ``source`` and ``chunk`` with ``extra`` and ``open``, where each
    is taken ``wanted`` times in the mean."""
    ship(rows.sparkSession)

    def run(key, table):
        table, size = _ordered(table)
        wanted = table["wanted"].to_numpy()
        whole = np.floor(wanted)
        share, _ = cube.settle(size, wanted - whole, _generator(level, key), land=land)
        left = (share > 0) & (share < 1)
        extra = table["extra"].to_numpy() + whole.astype(np.int64) + (share == 1)
        out = table.select(COLUMNS).append_column("extra", pa.array(extra, pa.int64()))
        return out.append_column("open", pa.array(share, mask=~left))

    return rows.groupBy("source", "chunk").applyInArrow(run, _type(rows))


def mix(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``
    and ``taken`` of every row of ``rows``, as of :func:`sizes`."""
    rows = rows.select("doc_id", F.col("source").cast("string").alias("source"), "size", "text_hash")
    units = scratch.stage(
        rows.groupBy("doc_id", "source", "size", "text_hash")
        .agg(F.count(F.lit(1)).alias("m"))
        .withColumn("spot", F.xxhash64("doc_id", "text_hash")),
        "units",
    )
    sources = targets(units, scratch)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio)
    about = sources.select("source", "n", "source_size", whole.alias("whole"), (ratio - whole).alias("share"))
    placed = _with(units, about)
    is_head = (F.col("size") * HEADS >= F.col("source_size")) & (F.col("size") > 0)
    done = [placed.where(F.col("share") == 0).select(*units.columns, F.lit(0).cast("long").alias("extra"))]

    tail = placed.where((F.col("share") > 0) & ~is_head)
    m = F.col("m").cast("decimal(38,0)")
    # exact sums, the same however the rows lie
    stats = tail.groupBy("source").agg(
        F.sum("m").cast("double").alias("tail_n"),
        F.sum(F.col("m") * F.col("size")).cast("double").alias("tail_sum"),
        F.sum(m * F.col("size") * F.col("size")).cast("double").alias("tail_squares"),
        F.max("size").cast("double").alias("tail_most"),
    )
    heads = _with(placed.where((F.col("share") > 0) & is_head), stats)
    # rows of a source that hold a HEADS-th of its words: HEADS at most
    settled = scratch.stage(_settled_heads(heads), "heads")
    columns = [*units.columns, "extra"]
    done.append(settled.where("open IS NULL").select(*columns))
    lines = settled.groupBy("source").agg(F.first("base").alias("base"), F.first("slope").alias("slope"))
    share = F.coalesce(F.col("base") + F.col("slope") * F.col("size"), F.col("share"))
    chunk = F.pmod("spot", F.ceil(F.col("n") / CHUNK)).cast("long")
    chunked = _with(tail, lines).withColumns(
        {
            "wanted": F.col("m") * F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)),
            "extra": F.lit(0).cast("long"),
            "chunk": chunk,
        }
    )
    found = scratch.stage(_settled(chunked, 1), "chunks")
    done.append(found.where("open IS NULL").select(*columns))
    left = settled.drop("base", "slope").where("open IS NOT NULL").unionAll(found.where("open IS NOT NULL"))
    level = 2
    while True:
        left = scratch.stage(left, "left")
        counts = left.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
        last = (counts.agg(F.max("chunks")).first()[0] or 0) <= 1
        chunked = _with(left.withColumnRenamed("open", "wanted"), counts).withColumn(
            "chunk", F.pmod(F.xxhash64("spot", F.lit(level)), "chunks").cast("long")
        )
        found = scratch.stage(_settled(chunked, level, land=last), "settled")
        done.append(found.where("open IS NULL").select(*columns))
        if last:
            break
        left, level = found.where("open IS NOT NULL"), level + 1
    decided = done[0]
    for more in done[1:]:
        decided = decided.unionAll(more)
    return _with(_each(decided), sources.select("source", "source_size", "target", whole.alias("whole"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("more")).alias("copies"),
        (F.col("size") * (F.col("whole") + F.col("more"))).alias("taken"),
    )


def _each(units: DataFrame) -> DataFrame:
    """A row for each of a unit's equal rows; ``more`` is 1 for ``extra`` of them."""

    def rows(df, first, last):
        at = df.withColumn("i", F.explode(F.sequence(first, last)))
        return at.select("doc_id", "source", "size", (F.col("i") <= F.col("extra")).cast("long").alias("more"))

    one = F.lit(1).cast("long")
    few = rows(units.where(F.col("m") <= PIECE), one, F.col("m"))
    parts = units.where(F.col("m") > PIECE).withColumn(
        "part", F.explode(F.sequence(one, F.ceil(F.col("m") / PIECE)))
    )
    end = F.col("part") * PIECE
    spread = parts.repartition(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return few.unionAll(rows(spread, end - PIECE + 1, F.least(end, F.col("m"))))


def mixture(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken.

    The rows are stored with a number (a column ``mixed_row`` of ``docs`` is
    replaced by it), so that equal rows are told apart.
    """
    numbered = scratch.stage(docs.withColumn("mixed_row", F.monotonically_increasing_id()), "documents")
    decided = mix(sizes(numbered.select(F.col("mixed_row").alias("doc_id"), "source", "text")), scratch)
    taken = decided.where("copies > 0").select(F.col("doc_id").alias("mixed_row"), F.col("copies").alias("__copies"))
    return (
        numbered.join(taken, "mixed_row")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
        .drop("__copy", "__copies")
    )
