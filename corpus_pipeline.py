"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``.  All but the last keep the
columns of documents (``doc_id, text, lang, source, n_chars``).

Defined cases: a null text is an empty one to every stage and is kept or
dropped as that; equal rows fare alike, except that of a near-duplicate group
one row stays, that of the least ``doc_id`` and among equal ids the one whose
other columns come first; extra columns are dropped; empty tables stay empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, pieces, quality, secrets, simhash
from ledgerloom.llm.queries import learned_rows, table
from ledgerloom.sources.scratch import Scratch, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, learned_rows(table(spark, sf_dir, "labels")))
    return quality.score(docs, model).where("predicted = 1").select(*COLUMNS)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the least id's."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "row_hash")
    near = simhash.near_duplicates(docs.select(*COLUMNS), Scratch(spark))
    # a null id comes last; the text's hash decides between rows of one id
    rank = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "row_hash")
    kept = (
        near.groupBy("root")
        .agg(F.min(rank).alias("first"))
        .select("first.doc_id", "first.row_hash")
        .select(key.alias("row_key"))
        .distinct()
    )
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("row_hash")).withColumn("row_key", key)
    # equal keys are the same id and text: repeated rows, of which one stays
    own = Window.partitionBy("row_key").orderBy("lang", "source", "n_chars")
    return (
        rows.join(kept, "row_key")
        .withColumn("place", F.row_number().over(own))
        .where("place = 1")
        .select(*COLUMNS)
    )


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    docs = docs.select(*COLUMNS)
    keys, scratch = ["doc_id", "row_hash"], Scratch(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), scratch)
    leaked = scratch.stage(found.where("contaminated").select(*keys).distinct(), "leaked")
    rows = docs.withColumn("row_hash", F.xxhash64("text"))
    return decontaminate.same_row(rows, leaked, keys, "left_anti").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret."""
    rows = secrets.scan(
        docs.select(*COLUMNS),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        redacted="text",
    )
    changed = F.size("spans") > 0
    size = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", size).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, the pieces' places, and whether they decode
    to the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(docs.select(*COLUMNS), model, decoded="decoded")
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        "offsets",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_distinct),
    ("benchmark decontamination", drop_leaked),
    ("secret scans", hide_secrets),
    ("SentencePiece encoding and decoding", encode),
]

#: Classifier, fingerprints and tokenizers are not to be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    root = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{root}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
