"""Whitening of embeddings: distinct vectors are fitted by how often they occur and whitened once each.

Entries become integers, so equal vectors are equal exactly, and sums are exact. The covariance is a weighted product of
centred vectors, formed per task and added up; the driver holds the sums and products of one length of
vectors only (d and d * d numbers), never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 62)  # of a scaled entry; larger ones have no 64-bit form
LONG = (1 << 63) - 1
SAFE = 1 << 62
COMPONENTS = 8
HOT_SHARE = 1000  # vectors with a thousandth of all rows or more: a thousand of them at most
RANK_TOLERANCE = 1e-10  # of the largest eigenvalue; below it a direction has no variance


@dataclass(frozen=True)
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def usable(embedding: Column) -> Column:
    """Whether a vector has entries, all of them finite and with a 64-bit form."""
    fits = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < LARGEST))
    return F.coalesce(fits & (F.size(embedding) > 0), F.lit(False))


def as_integers(embedding: Column) -> Column:
    """``floor(1024 * c) + 100000`` of each entry."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def vector_key(x: Column) -> Column:
    """SHA-256 of the integers: what rows and distinct vectors are joined by."""
    return F.unhex(F.sha2(F.array_join(x.cast("array<string>"), ","), 256))


def _vectors(column: pa.Array, dims: np.ndarray, kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of a batch by length: length, places, matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(dims)
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, flat[(ends[at] - d)[:, None] + np.arange(d)].astype(kind, copy=False)


def _exact_sum(x: np.ndarray, weight: np.ndarray) -> list[int]:
    if np.abs(x).max(initial=0).item() * int(weight.sum()) < SAFE:
        return (weight @ x).tolist()
    return (weight.astype(object) @ x.astype(object)).tolist()


def integer_sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length, the number of vectors and the sum of each dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            weight, dims = batch.column("weight").to_numpy(), batch.column("dims").to_numpy()
            for d, at, x in _vectors(batch.column("x"), dims, np.int64):
                n, sums = found.get(d, (0, [0] * d))
                more = _exact_sum(x, weight[at])
                found[d] = n + int(weight[at].sum()), [a + b for a, b in zip(sums, more, strict=True)]
        if found:
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array([d for d in found for _ in range(d)], pa.int32()),
                    "i": pa.array([i for d in found for i in range(d)], pa.int32()),
                    "n": pa.array([found[d][0] for d in found for _ in range(d)], pa.int64()),
                    "s": pa.array([s for d in found for s in found[d][1]], pa.decimal128(38)),
                }
            )

    parts = distinct.select("dims", "x", "weight").mapInArrow(run, "dims int, i int, n long, s decimal(38,0)")
    added = parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rows = added.orderBy("dims", "i").collect()
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        found.setdefault(r["dims"], (r["n"], []))[1].append(int(r["s"]))
    return found


def covariance(
    vectors: DataFrame, column: str, centres: dict[int, np.ndarray], totals: dict[int, int]
) -> dict[int, np.ndarray]:
    """By length in ``dims``, the covariance of the array column over the weights: centred, multiplied, divided by the
    total weight.

    A task adds up its blocks of rows; the tasks' products are added up by Spark before the driver takes
    one of each length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            weight, dims = batch.column("weight").to_numpy(), batch.column("dims").to_numpy()
            lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                part = batch.take(pa.array(own))
                for _, _, x in _vectors(part.column(column), lengths[own], np.float64):
                    y = x - centres[int(d)]
                    products[int(d)] = products.get(int(d), 0) + (y * weight[own][:, None]).T @ y
        for d, product in products.items():
            size = len(product)
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array([d] * size, pa.int32()),
                    "i": pa.array(range(size), pa.int32()),
                    "line": pa.array(list(product), pa.list_(pa.float64())),
                }
            )

    parts = vectors.select("dims", column, "weight").mapInArrow(run, "dims int, i int, line array<double>")
    cells = parts.select("dims", "i", F.posexplode("line").alias("j", "v")).groupBy("dims", "i", "j").agg(F.sum("v").alias("v"))
    found = {d: np.zeros((len(c), len(c))) for d, c in centres.items()}
    for batch in cells.toArrow().to_batches():
        dims, i, j, v = (batch.column(k).to_numpy() for k in range(4))
        for d in np.unique(dims):
            at = dims == d
            found[int(d)][i[at], j[at]] = v[at]
    return {d: (m + m.T) / 2 / totals[d] for d, m in found.items()}


def fit(distinct: DataFrame) -> dict[int, Fit]:
    """By length, the eigenvectors of the covariance of ``distinct`` (``x``, ``dims``, ``weight``)."""
    sums = integer_sums(distinct)
    means = {d: np.array([s / n for s in each]) for d, (n, each) in sums.items()}
    found = {}
    for d, matrix in covariance(distinct, "x", means, {d: n for d, (n, _) in sums.items()}).items():
        values, vectors = np.linalg.eigh(matrix)
        found[d] = Fit(*sums[d], values[::-1], vectors[:, ::-1], float(np.trace(matrix)))
    return found


def deviations(x: np.ndarray, known: Fit) -> list[int | None]:
    """The sum over dimensions of (n * x - S) squared, exact; None where it has no 64-bit form."""
    if max(abs(int(x.max())), abs(int(x.min()))) * known.n + max(map(abs, known.sums)) < SAFE:
        y = x * known.n - np.array(known.sums, np.int64)
        if int(np.abs(y).max()) ** 2 * x.shape[1] < SAFE:
            return np.einsum("ij,ij->i", y, y).tolist()
    y = x.astype(object) * known.n - np.array(known.sums, object)
    exact = (y * y).sum(axis=1).tolist()
    return [e if e <= LONG else None for e in exact]


def whiten_distinct(distinct: DataFrame, fits: dict[int, Fit], components: int) -> DataFrame:
    """``key``, ``dims``, ``weight``, ``copies``, ``deviation`` and ``whitened`` of each distinct vector."""
    scaled = {}
    for d, known in fits.items():
        rank = int((known.values > RANK_TOLERANCE * max(known.values[0], 0)).sum()) if known.values[0] > 0 else 0
        kept = min(components, rank)
        scaled[d] = known.vectors[:, :kept] / np.sqrt(known.values[:kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation = np.empty(batch.num_rows, object)
            whitened = np.empty(batch.num_rows, object)
            for d, at, x in _vectors(batch.column("x"), batch.column("dims").to_numpy(), np.int64):
                deviation[at] = deviations(x, fits[d])
                for place, row in zip(at, (x - fits[d].mean) @ scaled[d], strict=True):
                    whitened[place] = row
            columns = [batch.column(c) for c in ("key", "dims", "weight", "copies")]
            columns += [pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "dims", "weight", "copies", "deviation", "whitened"])

    shape = "key binary, dims int, weight long, copies long, deviation long, whitened array<double>"
    return distinct.select("key", "x", "dims", "weight", "copies").mapInArrow(run, shape)


def identity_errors(whitened: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float | None]:
    """By length, the largest absolute entry of the covariance of what was whitened minus the identity."""
    total = {d: known.n for d, known in fits.items()}
    sums = (
        whitened.select("dims", "weight", F.posexplode("whitened").alias("k", "v"))
        .groupBy("dims", "k")
        .agg((F.sum(F.col("v") * F.col("weight"))).alias("s"))
        .orderBy("dims", "k")
        .collect()
    )
    centres = {d: np.array([r["s"] / total[d] for r in sums if r["dims"] == d]) for d in total}
    found = covariance(whitened, "whitened", centres, total)
    return {d: float(np.abs(m - np.eye(len(m))).max()) if len(m) else None for d, m in found.items()}


def _by_length(values: dict[int, object], kind: str) -> Column:
    pairs = [F.lit(x) for d, v in values.items() for x in (d, v)]
    return F.element_at(F.create_map(*pairs).cast(f"map<int,{kind}>"), F.col("dims")) if pairs else F.lit(None).cast(kind)


def whiten(vectors: DataFrame, components: int = COMPONENTS, multiplicity: bool = True) -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``vectors`` has ``vec_id``, ``embedding``; further columns are ignored. Vectors that are null, empty or hold a null or
    non-finite entry, or one whose integer form exceeds 64 bits, are left out. Distinct vectors count as often as
    they occur, or once each without ``multiplicity``. Vectors of each length are fitted by themselves. Components are
    numbered from 1 by falling eigenvalue; those without variance (a ten-billionth of the largest at most) are left
    out, so equal vectors alone give no rows. ``deviation`` is null where it exceeds 64 bits. Repeated rows and null
    ids are rows like others; no rows give no rows.

    Rows meet the distinct vectors by a digest of their integers. Vectors that make up a thousandth of all rows
    or more, a thousand at most, are broadcast; of the others no key has more than that share.
    """
    rows = vectors.where(usable(F.col("embedding"))).select("vec_id", as_integers(F.col("embedding")).alias("x"))
    distinct = publish(
        rows.groupBy("x")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(
            vector_key(F.col("x")).alias("key"),
            "x",
            F.size("x").alias("dims"),
            "copies",
            (F.col("copies") if multiplicity else F.lit(1).cast("long")).alias("weight"),
        ),
        "distinct-vectors",
    )
    fits = fit(distinct)
    done = publish(whiten_distinct(distinct, fits, components), "whitened-vectors")
    errors = identity_errors(done, fits, components)

    total = done.agg(F.sum("copies")).first()[0] or 0
    hot = done.where(F.col("copies") * HOT_SHARE >= total).hint("broadcast")
    cold = done.where(F.col("copies") * HOT_SHARE < total)
    keyed = rows.select("vec_id", vector_key(F.col("x")).alias("key"))
    frequent = keyed.join(hot, "key")
    rare = keyed.join(hot.select("key"), "key", "left_anti").join(cold, "key")
    share = F.lit(None).cast("array<double>")
    for d, known in fits.items():
        if known.trace > 0:
            parts = F.array(*[F.lit(float(v / known.trace)) for v in known.values[:components]])
            share = F.when(F.col("dims") == d, parts).otherwise(share)
    return (
        frequent.unionByName(rare)
        .select("*", F.posexplode("whitened").alias("place", "value"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            _by_length({d: f.n for d, f in fits.items()}, "bigint").alias("n"),
            "deviation",
            F.col("value").alias("whitened"),
            F.get(share, F.col("place")).alias("explained"),
            _by_length(errors, "double").alias("identity_error"),
        )
    )
