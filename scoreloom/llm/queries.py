"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from scoreloom.llm import bpe, ctw, embeddings, language, prefixes, quality, simhash
from scoreloom.llm.merkle import row_manifest
from scoreloom.llm.mixing import mix
from scoreloom.llm.packing import pack
from scoreloom.llm.sharding import shard
from scoreloom.llm.warc import capture_digests
from scoreloom.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score(table(spark, sf_dir, "documents"), remainder(7) != 2)
    return scored.select(
        "doc_id", (remainder(7) == 2).alias("held_out"), *scored.drop("doc_id").columns
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), tiers=(2048, 1024, 512, 256))


def quality_network(spark: SparkSession, sf_dir: str) -> quality.Network:
    labels = table(spark, sf_dir, "labels").where(remainder(5) != 0)
    known = labels.select("doc_id", F.col("quality").alias("label"))
    return quality.train(quality.sample(table(spark, sf_dir, "documents"), known))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, quality_network(spark, sf_dir), threshold=0.3)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    raw = language.dictionaries(docs.where(remainder(4) != 2))
    found = language.predict(docs.select("doc_id", "text"), raw)
    return found.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "margin"
    )


def op5_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.fingerprints(table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_digests(table(spark, sf_dir, "pages"), min_revisit_bytes=0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return classes.select("doc_id", "fingerprint", "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(coded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_manifest(table(spark, sf_dir, "documents"), every=4)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


QUERIES = {
    f.__name__: f
    for f in (
        op1_ctw,
        op2_packing,
        op3_quality,
        op4_language,
        op5_prefixes,
        op6_embeddings,
        op7_mixing,
        op8_warc,
        op9_simhash,
        op10_sharding,
        op11_bpe,
        op12_merkle,
        op13_whitening,
    )
}
