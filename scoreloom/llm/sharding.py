"""Sharding by proportional stratified interleaving.

Each source's rows are put in a seeded order; row ``r`` of ``n`` gets the fractional rank
``(r + 1/2) / n``. Sorting all rows by that rank spreads every source evenly, and cutting the
sequence into equal ranges gives every shard the mixture of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.positions import numbered
from scoreloom.sources.shared import publish

ROW_OVERHEAD = 8


def shard(docs: DataFrame, shards: int = 24, seed: str = "shard") -> DataFrame:
    """Every row's shard and place: ``doc_id``, ``source``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``docs`` has ``doc_id``, ``text``, ``source``; further columns are ignored. The law is `rows`:
    the counts of the shards differ by one at most, and so do the counts of a source in them, up to
    ties in rank. ``slot`` numbers a shard's rows from 0 without gaps. ``size`` is the text's UTF-8
    bytes plus 8; ``text_crc32`` is that of the bytes.

    A null text counts as empty. A null source is a source of its own. Rows with a null ``doc_id``,
    equal texts and repeated rows are ordinary rows; rows equal in all columns are
    interchangeable. With fewer rows than shards the first shards have one row each. No rows give
    no rows. Both sorts move ids, sizes and checksums only, and split at row level, so that a
    large source is spread over all tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    text_key = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text_key).alias("key"),
    )
    tie = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    by_source = publish(numbered(rows, [F.asc_nulls_last("source"), *tie], "at"), "shard-rows")
    sources = by_source.groupBy(F.col("source").alias("_source")).agg(
        F.min("at").alias("start"), F.count(F.lit(1)).alias("n")
    )
    total = by_source.count()
    ranked = (
        by_source.join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rank", (F.col("at") - F.col("start") + 0.5) / F.col("n"))
        .drop("at", "start", "n", "_source")
    )
    placed = numbered(ranked, [F.col("rank"), F.asc_nulls_last("source"), *tie], "at")
    number = F.expr(f"at * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", number.cast("int"))
        .withColumn("slot", F.col("at") - first)
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
