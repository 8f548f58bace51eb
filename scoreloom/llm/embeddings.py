"""Near-duplicate embeddings by int8 tile products with error bounds.

Vectors are scaled to length one and rounded to int8 with one scale each. With ``e`` the distance
between a vector and its rounded form, two vectors' product differs from the rounded product by
at most ``e_x + |x'| e_y``. So every pair that may reach the threshold is known, and only those are
computed again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.graph import components
from scoreloom.sources.shared import publish

TILE = 512
EXACT = 1 << 24  # integers up to here are exact in single precision
SLACK = 1e-9  # far above the rounding of double sums, far below a quantisation step


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 forms of the directions, their scales, their lengths and the rounding errors' lengths."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rounded = codes * scale[:, None]
    length = np.sqrt(np.einsum("ij,ij->i", rounded, rounded))
    error = np.sqrt(np.einsum("ij,ij->i", unit - rounded, unit - rounded))
    return codes, scale, length, error


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def tile_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``x`` and ``y`` (of ``x`` alone, first below second, where ``y`` is None) whose
    cosine is at least ``threshold``."""
    cx, sx, lx, ex = quantise(x)
    cy, sy, _, ey = quantise(y) if y is not None else (cx, sx, lx, ex)
    kind = np.float32 if x.shape[1] * 127 * 127 < EXACT else np.float64
    product = (cx.astype(kind) @ cy.astype(kind).T) * sx[:, None] * sy[None, :]
    bound = ex[:, None] + lx[:, None] * ey[None, :] + SLACK
    possible = product + bound >= threshold
    if y is None:
        possible = np.triu(possible, 1)
    a, b = np.nonzero(possible)
    other = x if y is None else y
    sure = [
        cosine(x[a[s : s + 8192]], other[b[s : s + 8192]]) >= threshold for s in range(0, len(a), 8192)
    ]
    keep = np.concatenate(sure) if sure else np.zeros(0, bool)
    return a[keep], b[keep]


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest index that each of n points reaches over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def tile_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``links``, ``root``: per tile and vector, the vectors linked there, repeats counted, and a
    vector of the same tile that it is connected to.

    ``vectors`` has ``node``, ``embedding`` (double), ``copies`` and the group ``label``, ``dims``. Groups are cut
    into blocks of about ``TILE``; two blocks make a tile, which is one row of a task.
    """
    counts = vectors.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    blocks = (
        vectors.join(counts, ["label", "dims"])
        .withColumn("mine", F.expr("pmod(xxhash64(node), blocks)").cast("int"))
        .groupBy("label", "dims", "blocks", "mine")
        .agg(F.collect_list(F.struct("node", "copies", "embedding")).alias("members"))
    )
    tiles = (
        blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("label", "dims", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        .agg(F.collect_list(F.struct("mine", "members")).alias("sides"))
        .where("i = j or size(sides) = 2")
        .select("dims", "sides")
    )

    def side(members: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, copies, embedding = (members.field(k) for k in range(3))
        values = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return node.to_numpy(zero_copy_only=False), copies.to_numpy(zero_copy_only=False), values.reshape(-1, dims)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, sides in zip(batch.column("dims").to_pylist(), batch.column("sides"), strict=True):
                parts = [side(sides.values.field(1)[k].values, dims) for k in range(len(sides.values))]
                nodes = np.concatenate([p[0] for p in parts])
                copies = np.concatenate([p[1] for p in parts])
                a, b = tile_pairs(parts[0][2], parts[1][2] if len(parts) == 2 else None, threshold)
                if len(parts) == 2:
                    b = b + len(parts[0][0])
                linked = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
                own = np.nonzero(linked)[0]
                root = _lowest(len(nodes), a, b)[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[own]), pa.array(linked[own].astype(np.int64)), pa.array(nodes[root])],
                    ["node", "links", "root"],
                )

    return tiles.mapInArrow(link, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    ``vectors`` has ``vec_id``, ``embedding``, ``label``; further columns are ignored. Vectors are compared
    when their labels are equal and not null and their lengths are equal. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing and are kept. Equal vectors
    are compared once and counted as often as they occur, so a group of copies costs one row.
    ``n_links`` counts the other vectors linked directly, repeated rows included. A null ``vec_id``
    takes part in links, but is never the smallest; it is never kept. No rows give no rows.
    """
    usable = (
        F.col("label").isNotNull()
        & F.coalesce(
            F.forall(
                "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
            )
            & F.exists("embedding", lambda x: x != 0),
            F.lit(False),
        )
    )
    rows = vectors.select("vec_id", "label", "embedding", usable.alias("usable"))
    distinct = publish(
        rows.where("usable")
        .groupBy("label", "embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .select(
            "*", F.size("embedding").alias("dims"), F.monotonically_increasing_id().alias("node")
        ),
        "vectors",
    )
    found = publish(tile_links(distinct, threshold), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    stars = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = distinct.join(stars.withColumnRenamed("v", "node"), "node", "left").withColumn(
        "root", F.coalesce("m", "node")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    described = publish(
        rooted.join(smallest, "root")
        .join(links, "node", "left")
        .select(
            F.col("label").alias("_label"),
            F.col("embedding").alias("_embedding"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "component_id",
        ),
        "vector-classes",
    )
    linked = rows.where("usable").join(
        described,
        (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")),
    )
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
