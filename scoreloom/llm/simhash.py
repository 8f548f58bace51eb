"""SimHash near-duplicates, with candidates pruned by the pigeonring principle.

If two fingerprints of ``m`` segments on a ring differ in at most ``t`` bits, some segment starts a
chain whose first ``l`` segments differ in at most ``l * t / m`` bits, for every ``l``. The segments whose
budget is below one must be equal; of those whose budget is below two, at most one may differ. So two
fingerprints within the distance agree, for some start, on the first kind and on all but one of the
second, which is what they are joined on. Chains are then checked in full before the distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.graph import components
from scoreloom.sources.shared import publish

BITS, SEED = 64, 42
TILE = 2048  # fingerprints of a bucket that are compared with as many others in one task


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a text as a signed 64-bit number; 0 for null and for no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _masks(segments: int, distance: int) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """For each start, the chain as (mask, budget) by length; all keys as (start, mask)."""
    width = BITS // segments
    segment = [((1 << width) - 1) << (BITS - width * (s + 1)) for s in range(segments)]
    budget = [(n + 1) * distance // segments for n in range(segments)]
    chains, keys = [], []
    for start in range(segments):
        ring = [segment[(start + n) % segments] for n in range(segments)]
        chains.append([(sum(ring[: n + 1]), budget[n]) for n in range(segments)])
        equal = sum(m for m, b in zip(ring, budget, strict=True) if b == 0)
        loose = [m for m, b in zip(ring, budget, strict=True) if b == 1]
        keys += [(start, equal | (sum(loose) - one)) for one in loose] or [(start, equal)]
    return chains, keys


def _forest(points: np.ndarray, chain: list[tuple[int, int]], distance: int) -> list[tuple[int, int]]:
    """Links that connect what the chain and the distance connect, one less than points at most."""
    rest, links = points, []
    while len(rest) > 1:
        open_, rest = [rest[0]], rest[1:]
        while open_ and len(rest):
            point = open_.pop()
            differ = rest ^ point
            near = np.arange(len(rest))
            for mask, most in chain:
                near = near[np.bitwise_count(differ[near] & np.uint64(mask)) <= most]
            near = near[np.bitwise_count(differ[near]) <= distance]
            links += [(point, x) for x in rest[near]]
            open_ += list(rest[near])
            rest = np.delete(rest, near)
    return links


def near_links(prints: DataFrame, distance: int = 3, segments: int = 8) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect all pairs at most
    ``distance`` bits apart. Not every such pair is a row: a bucket gives a forest.

    A bucket of two is compared in place. A larger one is cut into tiles of about ``TILE`` by ``TILE``
    fingerprints, each a task's row, so that no bucket has to fit into a task.
    """
    if BITS % segments or not 0 <= distance < 2 * segments:
        raise ValueError("segments must divide 64 and exceed half the distance")
    chains, masks = _masks(segments, distance)
    probes = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(n).cast("short").alias("k"),
                    F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value"),
                )
                for n, (_, mask) in enumerate(masks)
            ]
        )
    )
    keyed = prints.select("fp", probes.alias("p")).select("fp", "p.k", "p.value")
    buckets = publish(
        keyed.groupBy("k", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "simhash-buckets",
    )

    differ = F.col("a").bitwiseXOR(F.col("b"))
    in_chain = F.lit(False)
    for start, chain in enumerate(chains):
        own = [n for n, (s, _) in enumerate(masks) if s == start]
        within = [F.bit_count(differ.bitwiseAND(F.lit(_signed(m)))) <= most for m, most in chain]
        whole = F.col("k").isin(own)
        for one in within:
            whole = whole & one
        in_chain = in_chain | whole
    twos = buckets.where("n = 2").where(in_chain).where(F.bit_count(differ) <= distance).select("a", "b")

    blocks = F.ceil(F.col("n") / TILE).cast("int")
    many = keyed.join(
        buckets.where("n > 2").select("k", "value", blocks.alias("blocks")), ["k", "value"]
    ).withColumn("mine", F.expr("pmod(xxhash64(fp), blocks)").cast("int"))
    tiles = (
        many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("k", "value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        .agg(F.collect_list("fp").alias("points"))
        .select("k", "points")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            points, kinds = batch.column("points"), batch.column("k").to_pylist()
            values = points.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(points.value_lengths().to_numpy(zero_copy_only=False))
            for kind, end, start in zip(kinds, ends, [0, *ends[:-1]], strict=True):
                found += _forest(values[start:end], chains[masks[kind][0]], distance)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return twos.union(tiles.mapInArrow(link, "a long, b long"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    segments: int = 8,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed), ``fingerprint`` (hex), ``component_id``, ``class_fp`` and
    the columns in ``carry``.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. ``component_id`` is the smallest
    ``doc_id`` that can be reached over links; equal fingerprints are linked. ``class_fp`` is one
    fingerprint of the class, the same for all its rows. Null and empty
    texts and texts of white space have the fingerprint zero, linked like any other. Repeated
    rows give repeated rows. A row with a null ``doc_id`` takes part in links, but is never the
    smallest; a class of nulls only has the component null. No rows give no rows.
    """
    rows = publish(docs.select("doc_id", *carry, fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    prints = publish(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    stars = components(near_links(prints.select("fp"), distance, segments))
    rooted = prints.join(stars.withColumnRenamed("v", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("m", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    class_fp = F.col("root").alias("class_fp")
    classes = publish(
        rooted.join(smallest, "root").select("fp", "component_id", class_fp), "simhash-classes"
    )
    return rows.join(classes, "fp").select(
        "doc_id",
        *carry,
        "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "class_fp",
    )
