"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words is one window.  Of every ``WINDOW`` words, the least hash of the
``GRAM``-word runs in them is kept as a fingerprint, so a document and an item
that share a window share one of its fingerprints: the same one is least in
both.  Fingerprints of documents and items are joined; each hit is extended to
the windows around it, and these are joined with the items' windows by their
words.  No shared window is missed, and none is reported that is not there.

Items of fewer words have one run, the window itself, as fingerprint; documents
then give their runs of each such length too.  Only the nine lengths below
``WINDOW`` are possible, and only those that occur cost anything.

What is joined: fingerprints (two of seven words), then only documents with a
hit once more.  Nothing is collected or broadcast by hand; items are as many
as they are, and equal windows of several items are compared once.

Defined cases: words are as in :func:`words`; a null text has none; an item
without words has no window; a document row is told from others by its id and
its text's hash, so equal rows give equal results, each its own row, and a
null id is an id like others; equal item ids count once; other columns are
ignored, whatever their names; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.sources.scratch import Scratch

WINDOW = 10
GRAM = 5
#: A fingerprint holds a hash above and the place of its run below.
PLACES = 1 << 24
LENGTH_BITS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _cut(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_WORD), "")


def _lower(word: Column) -> Column:
    """A-Z in lower case, nothing else; most words are ASCII alone."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and anything beyond ASCII, with A-Z in lower case."""
    return F.transform(_cut(text), _lower)


def _hashes(text: Column) -> Column:
    return F.transform(_cut(text), lambda w: F.xxhash64(_lower(w)))


def _runs(hashes: Column, length: int) -> Column:
    """Each run of ``length`` words: its hash above, its place below."""
    last = F.size(hashes) - length
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(length)])
            .bitwiseAND(F.lit(-PLACES))
            .bitwiseOR(i.bitwiseAND(F.lit(PLACES - 1))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _least(runs: Column, window: int) -> Column:
    """The least of each ``window`` runs in a row, the first of equal hashes."""
    last = F.size(runs) - window
    return F.when(
        last >= 0,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.least(*[F.get(runs, i + j) for j in range(window)]),
            )
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """A row per fingerprint of ``text``: its windows' ``length``, ``gram`` and ``place``.

    One more row per input row, of length 0, has the number of words as place.
    """
    kinds = [
        F.struct(F.lit(0).alias("length"), F.array(F.size("hashes").cast("long")).alias("marks")),
        F.struct(
            F.lit(WINDOW).alias("length"),
            _least(F.col("runs"), WINDOW - GRAM + 1).alias("marks"),
        ),
        *[
            F.struct(F.lit(n).alias("length"), _runs(F.col("hashes"), n).alias("marks"))
            for n in lengths
        ],
    ]
    run = F.col("length") > 0
    return (
        df.select(*keys, _hashes(F.col("text")).alias("hashes"))
        .select(*keys, "hashes", _runs(F.col("hashes"), GRAM).alias("runs"))
        .select(*keys, F.explode(F.array(*kinds)).alias("kind"))
        .select(*keys, "kind.length", F.explode("kind.marks").alias("mark"))
        .select(
            *keys,
            "length",
            F.when(run, F.col("mark").bitwiseAND(F.lit(-PLACES)))
            .otherwise(F.xxhash64(*keys))  # spread over tasks; length 0 joins with nothing
            .alias("gram"),
            F.when(run, F.col("mark").bitwiseAND(F.lit(PLACES - 1)))
            .otherwise(F.col("mark"))
            .alias("place"),
        )
    )


def _windows(items: DataFrame) -> DataFrame:
    """Each item's distinct windows: ``item_id``, ``length``, ``window``."""
    size = F.size("words")
    return (
        items.select("item_id", words(F.col("text")).alias("words"))
        .where(size > 0)
        .select(
            "item_id",
            F.least(size, F.lit(WINDOW)).alias("length"),
            # not explode: the filter inferred for it would repeat the words'
            # expression once for each word
            F.explode_outer(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(size - WINDOW, F.lit(0))),
                    lambda i: F.array_join(F.slice("words", i + 1, F.least(size, F.lit(WINDOW))), " "),
                )
            ).alias("window"),
        )
        .distinct()
    )


def decontaminate(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``,
    ``items`` (sorted ids as strings), ``spans`` (hit word ranges, merged) and
    ``contaminated``; ``row_hash`` is the text's.

    ``scratch`` takes what is known of the items and the hits, whose sizes Spark
    then knows when it chooses how to join them.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    keys = ["doc_id", "row_hash"]
    windows = scratch.stage(_windows(items), "windows")
    short = windows.where(F.col("length") < WINDOW).select("length").distinct()
    lengths = sorted(r["length"] for r in short.collect())  # nine at most
    prints = _fingerprints(
        windows.select("window").distinct().select(F.col("window").alias("text")), ["text"], lengths
    )
    size = F.size(F.split("text", " "))
    known = scratch.stage(
        prints.where(F.col("length") == F.least(size, F.lit(WINDOW))).select("length", "gram").distinct(),
        "fingerprints",
    )
    hits = scratch.stage(
        _fingerprints(rows, keys, lengths)
        .join(known.withColumn("known", F.lit(True)), ["length", "gram"], "left")
        .where("known or length = 0")
        .select(*keys, "length", "place"),
        "hits",
    )
    counted = hits.where("length = 0").select(*keys, F.col("place").alias("n_words"))
    starts = scratch.stage(_starts(hits.where("length > 0"), keys), "starts")
    found = scratch.stage(_extended(rows, starts, windows.select("window").distinct()), "found")
    spans = _merged(found, keys)
    listed = (
        found.join(windows, "window")
        .select(*keys, F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    per_text = same_row(spans, listed, keys, "left")
    none = F.array()
    return (
        same_row(counted, per_text, keys, "left")
        .withColumn("spans", F.coalesce("spans", none.cast("array<struct<begin:int,end:int>>")))
        .withColumn("items", F.coalesce("items", none.cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn(
            "n_hit",
            F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"]).cast("long"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def same_row(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on all ``keys``, where null equals null."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def _starts(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Per row, where windows around its hits may begin."""
    first = F.when(F.col("length") == WINDOW, F.col("place") - (WINDOW - GRAM)).otherwise(F.col("place"))
    return hits.groupBy(*keys).agg(
        F.collect_set(F.struct("length", first.alias("first"), "place")).alias("hits")
    )


def _extended(rows: DataFrame, starts: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows around each hit that an item has, by their words.

    A window's words are cut out before the windows become rows, so that no row
    holds the text; a window is a number (its begin and, in ``LENGTH_BITS``, its
    length) until then, as distinct numbers are found by hash.
    """
    keys = ["doc_id", "row_hash"]
    size = F.size("words")

    def around(hit):
        # every place of a run that is known modulo PLACES
        return F.transform(
            F.sequence(hit["first"], hit["place"]),
            lambda i: F.shiftleft(i.cast("long"), LENGTH_BITS) + hit["length"],
        )

    turns = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / PLACES)),
        lambda turn: F.transform(
            F.flatten(F.transform("hits", around)),
            lambda w: w + F.shiftleft((turn * PLACES).cast("long"), LENGTH_BITS),
        ),
    )

    def begin(w):
        return F.shiftright(w, LENGTH_BITS)

    def end(w):
        return begin(w) + w.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))

    inside = F.filter(F.array_distinct(F.flatten(turns)), lambda w: (begin(w) >= 0) & (end(w) <= size))
    cut = F.transform(
        inside,
        lambda w: F.struct(
            begin(w).cast("int").alias("begin"),
            end(w).cast("int").alias("end"),
            F.array_join(F.slice("words", begin(w).cast("int") + 1, (end(w) - begin(w)).cast("int")), " ").alias("window"),
        ),
    )
    # merged at any size: hits grow with the documents, so does what is shuffled
    return (
        same_row(rows.where("text is not null"), starts.hint("merge"), keys, "inner")
        .select(*keys, "hits", words(F.col("text")).alias("words"))
        .select(*keys, F.explode_outer(cut).alias("w"))
        .select(*keys, "w.*")
        .join(windows, "window")
        .distinct()
    )


def _merged(found: DataFrame, keys: list[str]) -> DataFrame:
    """Per row the sorted ``spans``, those that overlap or touch put together."""
    along = Window.partitionBy(*keys).orderBy("begin", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.coalesce(F.col("begin") > before, F.lit(True)), 1).otherwise(0)
    return (
        found.select(*keys, "begin", "end")
        .distinct()
        .withColumn("fresh", fresh)
        .withColumn("stretch", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "stretch")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    )
