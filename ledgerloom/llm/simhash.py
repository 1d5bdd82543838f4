"""SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has a bit set where over half of its shingles' hashes
have it.  Equal fingerprints are one node, whatever their number.  Fingerprints
that differ in ``RADIUS`` bits at most agree in one of ``RADIUS + 1`` blocks of
bits: each block's value is a bucket.  A bucket of over ``MOST`` fingerprints
is replaced by the buckets of the blocks of its other bits, which is as exact;
one that stays large is cut into chunks, and pairs of chunks are compared.

In a bucket, fingerprints are compared bit-sliced: bit planes lie vertically,
64 fingerprints to a word; for each distance in the sorted order, a plane is
compared with itself shifted, and the differences of 64 pairs are added at once
to carry-save counters.  Words whose pairs all exceed the radius are abandoned.
Of the pairs found in a block of rows only a spanning star goes on, so copies of
copies never become all their pairs.

Defined cases: a null, empty or blank text has fingerprint 0, linked like any
other; a text of fewer words than a shingle is one shingle; repeated rows and
ids are rows like others; a null id is never the least one of its component,
which is null if it has no other; other columns are ignored, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrow import map_arrow, slices, texts_of
from ledgerloom.llm.components import components
from ledgerloom.sources.scratch import Scratch

SHINGLE = 3
RADIUS = 3
SEED = 42
MOST = 512
LANES = 1 << 17
BITS = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Words end at ASCII white space, A-Z are lowered, nothing else changes."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = (np.concatenate([[0], ends[:-1] + 1])).tolist()
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, last)]  # noqa: B905
    bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    count = np.zeros(BITS, np.int64)
    for start in range(0, len(bits), 1 << 16):
        some = np.unpackbits(bits[start : start + (1 << 16)], axis=1, bitorder="little")
        count += some.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``row_hash`` (the text's) and ``fingerprint``, its bits as a
    signed 64-bit integer."""

    def run(batches):
        for batch in slices(batches, "text"):
            found = [fingerprint(t, shingle) for t in texts_of(batch, "text")]
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(bits)],
                names=["doc_id", "row_hash", "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row_hash"), "text")
    return map_arrow(rows, run, "doc_id long, row_hash long, fingerprint long")


def _blocks(left: int, radius: int) -> list[tuple[int, int]]:
    """First bit and size of ``radius + 1`` blocks of ``left`` bits."""
    edges = [left * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _bucketed(rows: DataFrame, left: int, radius: int) -> DataFrame:
    """Every row once per block of its ``left`` bits in ``rest``.

    ``bucket`` is a hash of the blocks taken and their values; equal hashes of
    different blocks only add comparisons.
    """
    def moved(value, by, right):
        if by >= BITS:
            return F.lit(0).cast("long")
        return F.shiftrightunsigned(value, by) if right else F.shiftleft(value, by)

    made = []
    for first, size in _blocks(left, radius):
        low = (1 << first) - 1
        rest = moved(moved(F.col("rest"), first + size, True), first, False).bitwiseOR(
            F.col("rest").bitwiseAND(F.lit(low))
        )
        value = moved(F.col("rest"), first, True).bitwiseAND(F.lit((1 << size) - 1))
        made.append(
            F.struct(
                F.xxhash64("bucket", F.lit(left), F.lit(first), value).alias("bucket"),
                rest.alias("rest"),
            )
        )
    return rows.select("fingerprint", F.explode(F.array(*made)).alias("b")).select(
        "fingerprint", "b.bucket", "b.rest"
    )


def _buckets(distinct: DataFrame, radius: int, most: int, scratch: Scratch) -> DataFrame:
    """``fingerprint`` and ``bucket``: every pair in reach is in some bucket together."""
    rows = distinct.select(
        "fingerprint", F.lit(0).cast("long").alias("bucket"), F.col("fingerprint").alias("rest")
    )
    left, done = BITS, None
    while True:
        rows = scratch.stage(_bucketed(rows, left, radius), "buckets")
        left -= min(size for _, size in _blocks(left, radius))
        counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = scratch.stage(rows.join(counts, "bucket"), "counted")
        small = rows.where(F.col("n") <= most).select("fingerprint", "bucket")
        done = small if done is None else done.unionAll(small)
        rows = rows.where(F.col("n") > most)
        if rows.isEmpty():
            return done
        if left // (radius + 1) < 8:
            break
    chunks = F.ceil(F.col("n") / (most // 2)).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), chunks).cast("int")
    pairs = rows.select(
        "fingerprint", "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other")
    ).select(
        "fingerprint",
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
    )
    return done.unionAll(pairs)


# -- comparison in a task ------------------------------------------------------


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row ``b`` has bit ``b`` of all values, 64 to a word, and two
    words of zeros at the end."""
    words = (len(values) + 63) // 64
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((BITS, 64 * (words + 2)), np.uint8)
    padded[:, : len(values)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    padded = np.zeros(64 * words, np.uint8)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


def near_pairs(values: np.ndarray, buckets: np.ndarray, radius: int) -> np.ndarray:
    """Places of pairs in one bucket that differ in ``radius`` bits at most.

    ``buckets`` is sorted.  A counter starts so that it overflows when one
    difference more than ``radius`` is added.
    """
    planes = planes_of(values)
    words = planes.shape[1] - 2
    digits = max(1, radius.bit_length())
    start = (1 << digits) - (radius + 1)
    full = ~np.uint64(0)
    found = []
    for shift in range(1, len(values)):
        together = buckets[:-shift] == buckets[shift:]
        if not together.any():
            break
        lanes = _packed(together, words)
        at = np.flatnonzero(lanes)
        over = ~lanes[at]
        counter = [np.full(len(at), full if start >> i & 1 else 0, np.uint64) for i in range(digits)]
        whole, part = divmod(shift, 64)
        for b in range(BITS):
            plane = planes[b]
            low = np.minimum(at + whole, words)
            other = plane[low]
            if part:
                other = other >> np.uint64(part) | plane[low + 1] << np.uint64(64 - part)
            carry = plane[at] ^ other
            for i in range(digits):
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if b % 8 == 7:
                live = over != full
                if not live.all():
                    at, over = at[live], over[live]
                    counter = [c[live] for c in counter]
                    if not len(at):
                        break
        if len(at):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(near)
            first = at[word] * 64 + lane
            found.append(np.stack([first, first + shift], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def star(pairs: np.ndarray, size: int) -> np.ndarray:
    """A link from each linked place to the least place it is connected to."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        for side in (0, 1):
            np.minimum.at(root, root[pairs[:, side]], low)
            np.minimum.at(root, pairs[:, side], low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(size))
    return np.stack([moved, root[moved]], 1)


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    """Links between the fingerprints of each bucket."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def links(last: bool):
            """Of all complete buckets; the rows of the last one are kept."""
            nonlocal held, count
            values = np.concatenate([v for v, _ in held])
            buckets = np.concatenate([b for _, b in held])
            cut = len(buckets) if last else int(np.searchsorted(buckets, buckets[-1]))
            held, count = [(values[cut:], buckets[cut:])], len(buckets) - cut
            if not cut:
                return None
            values, buckets = values[:cut], buckets[:cut]
            ends = values[star(near_pairs(values, buckets, radius), cut)].view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
            )

        for batch in batches:
            held.append(
                (
                    batch.column("fingerprint").to_numpy().view(np.uint64),
                    batch.column("bucket").to_numpy(),
                )
            )
            count += batch.num_rows
            if count >= LANES and (made := links(False)):
                yield made
        if count:
            yield links(True)

    together = rows.repartition("bucket").sortWithinPartitions("bucket")
    return map_arrow(together.select("fingerprint", "bucket"), run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    most: int = MOST,
) -> DataFrame:
    """``doc_id``, ``row_hash``, ``fingerprint`` (signed), ``component_id`` and
    ``root``, the component's least fingerprint, of every row."""
    prints = scratch.stage(fingerprints(docs, shingle), "prints")
    distinct = scratch.stage(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct"
    )
    links = _compare(_buckets(distinct, radius, most, scratch), radius)
    roots = components(links, scratch).withColumnRenamed("node", "fingerprint")
    linked = distinct.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fingerprint", "component_id", "root")
    return prints.join(named, "fingerprint").select(
        "doc_id", "row_hash", "fingerprint", "component_id", "root"
    )
