"""Token-ID output: Parquet files of token lists in document order.

Layout: one row per document with ``doc_id``, ``shard`` (write task),
``offset`` (ids before it in the shard), ``n_tokens`` and ``ids``.  Lists are
dictionary encoded, counts and offsets delta encoded where the writer finds no
dictionary worthwhile; row groups are small enough for one task, and pages
small enough for the page index to skip most of them.  Reading ``n_tokens``
alone does not touch the ids, and a filter on ``doc_id`` or on a document's
place reads only the pages that hold it.

Defined cases: a null or empty text is the end id alone; rows with equal or
null ``doc_id`` are kept, nulls first, ties ordered by text; other columns of
the input, whatever their names, are not written; an empty table gives an
empty file set with the same schema.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrow import int_lists, map_arrow, slices, texts_of
from ledgerloom.llm.codes import Codes
from ledgerloom.llm.parts import PartStore

END_ID = 0
WRITER = {
    "compression": "zstd",
    "parquet.block.size": 32 << 20,
    "parquet.page.size": 256 << 10,
    "parquet.page.row.count.limit": 256,
    "parquet.dictionary.page.size": 1 << 20,
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
}

#: Kinds of characters for the byte-level splitting rule; any other is OTHER.
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
KINDS = np.full(0x251, OTHER, np.uint8)
for code in range(0x250):
    char = chr(code)
    if char in "\t\n\v\f\r ":
        KINDS[code] = SPACE
    elif char.isalpha() and (code < 0x80 or code >= 0xC0):
        KINDS[code] = LETTER
    elif char in "0123456789":
        KINDS[code] = DIGIT
    elif 0x20 < code < 0x7F and char != "'":
        KINDS[code] = SIGN

FILES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


class Encoder:
    """The tokenizers library over whole texts, remembering words.

    The byte-level rule cuts a text into runs of one kind of character, with a
    single space before them, and encodes each on its own.  For texts of ASCII
    and Latin letters without apostrophes and double spaces the cuts are found
    here, and each distinct part is encoded by the library once; any other
    text, and one that holds a special token, is given to the library whole and
    leaves nothing in the store.
    """

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.store = PartStore(self._many)

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _many(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids."""
        laid = Codes.of(texts)
        kind = KINDS[np.minimum(laid.codes, len(KINDS) - 1)]
        space = kind == SPACE
        odd = kind == OTHER
        odd[1:] |= space[1:] & space[:-1]
        # the spaces around a text are no part of it
        odd[laid.starts - 1] = odd[laid.ends] = False
        whole = np.logical_or.reduceat(odd, np.minimum(laid.starts, len(odd) - 1))
        whole[laid.starts == laid.ends] = False
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                whole[i] = True
        if not whole.any():
            return self._by_parts(laid, kind)
        out: list = [None] * len(texts)
        apart, rest = np.flatnonzero(whole), np.flatnonzero(~whole)
        for i, made in zip(apart, self._many([texts[i] for i in apart]), strict=True):
            out[i] = np.array(made, np.int32)
        if len(rest):
            laid = Codes.of([texts[i] for i in rest])
            kind = KINDS[np.minimum(laid.codes, len(KINDS) - 1)]
            for i, made in zip(rest, self._by_parts(laid, kind), strict=True):
                out[i] = made
        return out

    def _by_parts(self, laid: Codes, kind: np.ndarray) -> list[np.ndarray]:
        """Each text's ids, where every text is cut by the kinds of its characters."""
        space, blank = kind == SPACE, laid.codes == 32
        cut = np.empty(len(kind), bool)
        cut[0] = True
        cut[1:] = (kind[1:] != kind[:-1]) & (space[1:] | ~blank[:-1])
        cut[laid.starts] = cut[laid.ends] = True
        begin = np.flatnonzero(cut)
        ids, after = self.store.encode(laid.codes, laid.joined, begin)
        # the spaces between texts are parts of their own, left out here
        low = after[np.searchsorted(begin, laid.starts)]
        high = after[np.searchsorted(begin, laid.ends)]
        return [ids[a:b] for a, b in zip(low, high, strict=True)]


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Documents in ascending ``doc_id`` order as rows of the file format."""
    end = np.int32(end_id)

    def run(batches):
        from pyspark import TaskContext

        encoder, shard, before = Encoder.of(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids = [np.append(x, end) for x in encoder.batch(texts_of(batch, "text"))]
            lengths = np.array([len(x) for x in ids], np.int64)
            starts = before + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            before += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ids), shard, np.int32)),
                    pa.array(starts.astype(np.int64)),
                    pa.array(lengths),
                    int_lists(np.concatenate(ids), lengths),
                ],
                names=FILES.names,
            )

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select(F.col("doc_id").cast("long"), "text")
    )
    return map_arrow(ordered, run, FILES)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, **options) -> None:
    encode(docs, tokenizer, end_id).write.options(**WRITER | options).parquet(path)


def _bases(rows: DataFrame) -> DataFrame:
    """Per shard its ids (``total``) and those of all shards before (``base``)."""
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # one row per write task: a window over all of them, and their broadcast, stay small
    return totals.selectExpr(
        "shard",
        "total",
        "coalesce(sum(total) over (order by shard rows between unbounded preceding and 1 preceding), 0) as base",
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``: the number of ids of all documents before."""
    rows = spark.read.schema(FILES).parquet(path)
    before = _bases(rows).drop("total")
    return rows.join(F.broadcast(before), "shard").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def read_span(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """Documents that hold any of the ids ``begin`` to ``end`` of the whole corpus, as
    of :func:`read`.

    The range is first turned into shards and offsets, from the small columns
    alone; the scan then filters by these, so only pages that hold such documents
    are read.
    """
    rows = spark.read.schema(FILES).parquet(path)
    met = _bases(rows).where((F.col("base") < end) & (F.col("base") + F.col("total") > begin))
    ends = met.agg(F.min(F.struct("shard", "base")), F.max(F.struct("shard", "base"))).first()
    if begin >= end or ends[0] is None:
        return read(spark, path).where(F.lit(False))
    (first, low), (last, high) = ends
    # the document with id ``begin``
    at = rows.where((F.col("shard") == first) & (F.col("offset") <= max(begin - low, 0)))
    offset = at.agg(F.max("offset")).first()[0]
    shard = F.col("shard")
    rows = rows.where(
        shard.between(first, last)
        & ((shard > first) | (F.col("offset") >= offset))
        & ((shard < last) | (F.col("offset") < end - high))
    )
    if first == last:  # a range of offsets alone, which the page index answers best
        rows = rows.where((F.col("offset") >= offset) & (F.col("offset") < end - high))
    bases = spark.read.schema(FILES).parquet(path)
    before = _bases(bases).drop("total")
    return rows.join(F.broadcast(before), "shard").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def crc32_of_ids(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``ids_crc32``: the checksum of the ids as 32-bit integers."""
    from zlib import crc32

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            sums = [crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(sums, pa.int64())],
                names=[*columns, "ids_crc32"],
            )

    kinds = T.StructType([rows.schema[c] for c in columns] + [T.StructField("ids_crc32", T.LongType())])
    return map_arrow(rows.select(*columns, "ids"), run, kinds)

