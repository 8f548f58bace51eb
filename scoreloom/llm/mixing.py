"""Mixing sources to target weights by capped water-filling.

Everything runs as DataFrame expressions. A source's target is its share of the total by weight,
clamped at ``max_epochs`` times its size; what clamped sources leave is shared among the others in
proportion to their weights until nobody is above the clamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.positions import numbered
from scoreloom.sources.shared import publish

WORD = r"[^\x20\x09-\x0D]+"
PLACE_BITS = 33  # of monotonically_increasing_id: partition above, place in the partition below


def word_count(text: Column) -> Column:
    """Number of words in a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def rotating_weights(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Give the sources, in code point order with null last, the weights in turn."""
    ranked = numbered(sizes, [F.asc_nulls_last("source")], "rank")
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    return ranked.withColumn("weight", turn).drop("rank")


def water_level(sources: DataFrame, total: int, max_epochs: int) -> float:
    """The level L at which the targets ``min(weight * L, max_epochs * size)`` add up to ``total``.

    Each round is one aggregate row: it clamps the sources that the present level fills and
    shares the rest among the others. The level only rises, so the rounds end when no further
    source is clamped.
    """
    cap = F.col("source_size") * max_epochs
    clamped, level = -1, 0.0
    while True:
        full = cap <= F.col("weight") * level
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(full, 1)).alias("clamped"),
        ).first()
        if row["clamped"] == clamped or not row["open"]:
            return level
        clamped, level = row["clamped"], (total - row["taken"]) / row["open"]


def running_sum(
    df: DataFrame, order: list[Column | str], value: str, name: str = "before"
) -> DataFrame:
    """The sum of ``value`` over all rows that come before each row in ``order``.

    The rows are sorted in parallel and stored with their partition and their place there. Sums run inside the
    partitions; one sum per partition passes through one task.
    """
    at = F.monotonically_increasing_id()
    part, place, start, inside = (f"{name}_{what}" for what in ("part", "place", "start", "inside"))
    stored = publish(
        df.orderBy(*order).select(
            "*",
            F.shiftright(at, PLACE_BITS).cast("int").alias(part),
            at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias(place),
        ),
        "mix-ordered",
    )
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(part)
        .agg(F.sum(value).alias(start))
        .select(part, F.coalesce(F.sum(start).over(earlier), F.lit(0)).alias(start))
    )
    ahead = Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.withColumn(inside, F.coalesce(F.sum(value).over(ahead), F.lit(0)))
        .join(starts, part)
        .withColumn(name, F.col(start) + F.col(inside))
        .drop(part, place, start, inside)
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    max_epochs: int = 3,
    total: int | None = None,
    seed: str = "mix",
    key: str = "doc_id",
) -> DataFrame:
    """One row per document with how often the mix takes it.

    ``docs`` has ``doc_id`` (or another integer column, named by ``key``), ``text``, ``source``; further columns
    are ignored. Returns ``doc_id`` (or ``key``), ``source``, ``size`` (words), ``source_size``, ``target`` (its
    source's), ``copies``, ``taken``.

    A source is taken ``floor(target / size)`` times whole. Of the rest, documents are taken once
    more in a seeded order for as long as at least half of the document lies within the rest, so
    a source misses its target by at most half a document.

    Null texts and texts without words have size 0 and are never a reason to pass a target. A
    null source is a source of its own, last in the order. Rows with a null ``doc_id`` and repeated
    rows are ordinary rows. A total of 0 gives targets of 0. No rows give no rows.
    """
    seeded = F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = publish(
        docs.select(
            key, "source", word_count(F.col("text")).alias("size"), F.md5(seeded).alias("_key")
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = publish(rotating_weights(sizes, weights), "mix-sources")
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, total, max_epochs)
    cap = (F.col("source_size") * max_epochs).cast("double")
    targets = sources.select(
        F.col("source").alias("_source"),
        "source_size",
        F.least(cap, F.col("weight") * F.lit(level)).alias("target"),
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("whole", F.coalesce(whole, F.lit(0)))

    order = [F.asc_nulls_last("source"), F.col("_key"), F.col(key), F.col("size")]
    placed = publish(running_sum(rows, order, "size", "before"), "mix-placed")
    starts = placed.groupBy(F.col("source").alias("_source")).agg(F.min("before").alias("start"))
    per_source = targets.join(
        starts.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    middle = F.col("before") - F.col("start") + F.col("size") / 2
    # where nothing is left, a document without words would still come before the rest's end
    once_more = F.when((rest > 0) & (middle <= rest), 1).otherwise(0)
    copies = (F.col("whole") + once_more).cast("long")
    return (
        placed.join(per_source, placed["source"].eqNullSafe(per_source["_source"]))
        .withColumn("copies", copies)
        .select(
            key,
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
