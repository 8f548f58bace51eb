"""From documents to packed sequences: the stages of the corpus pipeline.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of their input, whatever they are called.

Rows are documents: repeated ids and rows are looked at one by one, and of equal ones the near-duplicate stage keeps one.
Null and empty texts are scored like others by the first stage; the language stage drops those without a letter. No rows give no
rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import language, quality, simhash
from scoreloom.llm.mixing import mix
from scoreloom.llm.names import unused_name
from scoreloom.llm.packing import pack
from scoreloom.sources.shared import publish

MIN_MARGIN = 0.05  # the second best language must take a twentieth more bytes; see README for held-out margins


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of its input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.train(quality.sample(docs, labels.select("doc_id", F.col("quality").alias("label"))))
    score = unused_name(docs, "score")
    kept = docs.withColumn(score, quality.quality_score(network, F.col("text")))
    return kept.where(F.col(score) >= 0.3).drop(score)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with a margin; the dictionaries come from its input."""
    found = language.identify(language.dictionaries(docs), F.col("text"), MIN_MARGIN)
    known = unused_name(docs, "known")
    kept = docs.withColumn(known, found["lang"])
    return kept.where(F.col(known) != language.UNKNOWN).drop(known)


def numbered_rows(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a unique number, so that repeated and missing ids do no harm, and the name of that column."""
    row = unused_name(docs, "row")
    return publish(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, and one row of it.

    The texts meet the decisions in a sort-merge join at every size, as both sides grow alike.
    """
    rows, row = numbered_rows(docs, "dedup-rows")
    numbers = rows.select("doc_id", "text", F.col(row).alias("row"))
    classes = simhash.near_duplicates(numbers, shingle=3, distance=3, carry=("row",))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    stays = classes.groupBy("class_fp").agg(F.min(place)["row"].alias(row)).select(row)
    return rows.join(publish(stays, "dedup-stays").hint("merge"), row, "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times."""
    rows, row = numbered_rows(docs, "mix-documents")
    numbers = rows.select("doc_id", "source", "text", F.col(row).alias("row"))
    taken = mix(numbers, weights=(5.0, 2.0, 1.0), max_epochs=3, key="row")
    times = unused_name(rows, "times")
    copies = taken.where("copies > 0").select(
        F.col("row").alias(row), F.sequence(F.lit(1).cast("long"), F.col("copies")).alias(times)
    )
    repeated = rows.join(publish(copies, "mix-copies").hint("merge"), row)
    return repeated.select(*[F.col(c) for c in docs.columns], F.explode(times).alias(times)).drop(times)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens and less."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near-duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

#: No stage but mixing can be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = publish(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
