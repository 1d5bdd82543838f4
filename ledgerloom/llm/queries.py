"""The registered queries of the text operators: whole tables, full results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontaminate,
    embeddings,
    extract,
    language,
    licenses,
    mixing,
    pieces,
    quality,
    secrets,
    simhash,
    token_files,
    variants,
    whitening,
)
from ledgerloom.llm.oracles import ORACLES  # noqa: F401  given on with the queries
from ledgerloom.sources.scratch import Scratch


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rest(divisor: int):
    """Remainder of the checksum of ``doc_id`` as text; null counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    rows = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark)
    )
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def learned_rows(labels: DataFrame) -> DataFrame:
    """The labels that the quality classifier may learn from."""
    return labels.where(_rest(5) != 0)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, learned_rows(table(spark, sf_dir, "labels")))
    return quality.score(docs.withColumn("held_out", _rest(5) == 0), model).drop("text")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = licenses.of_documents(docs, licenses.fit(docs), Scratch(spark))
    return rows.withColumn("families", F.array_join("families", ","))


def op8_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, _rest(4) != 2)
    rows = docs.select("doc_id", "text", (_rest(4) == 2).alias("held_out"))
    return language.predict(rows, model).drop("text")


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secrets.scan(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return rows.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.written(of(*secrets.BASE)), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op4_extract(spark, sf_dir: str) -> DataFrame:
    rows = extract.extract(table(spark, sf_dir, "pages"), Scratch(spark))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("offsets", -1).alias("n_bytes"),
    )


def op9_embeddings(spark, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark))


def op10_token_files(spark, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("tokens")
    token_files.write(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    rows = token_files.read(spark, path)
    return token_files.crc32_of_ids(rows, ["doc_id", "start", "n_tokens"])


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = whitening.whiten(vectors, whitening.fit(vectors))
    return rows.select(
        "vec_id",
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "values"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "values.whitened",
        "values.explained",
        "identity_error",
    )


def op12_mixing(spark, sf_dir: str) -> DataFrame:
    rows = mixing.mix(mixing.sizes(table(spark, sf_dir, "documents")), Scratch(spark))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op13_variants(spark, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), Scratch(spark))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_extract": op4_extract,
    "op5_pieces": op5_pieces,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_language": op8_language,
    "op9_embeddings": op9_embeddings,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_variants": op13_variants,
}
