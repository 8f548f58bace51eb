"""Quality classification by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters
run over each chunk, and each filter's largest response in the chunk is kept. The mean and the
maximum of these over a document's chunks are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK, STEP = 256, 192  # bytes of a chunk and from one chunk's start to the next
BLOCK = 4  # a filter sees two blocks of bytes and moves by one byte
EMBED, FILTERS = 8, 16
SAMPLE_ROWS = 800  # labelled rows of each class that the network is fitted on, at most
SAMPLE_CHUNKS = 8  # chunks of a sampled document, spread evenly over all of it
STEPS = 700  # updates, whatever the size of the sample
BATCH, RATE = 32, 0.01
SCORED_BYTES = 1 << 20  # bytes of text whose chunks are in memory at once


@dataclass
class Network:
    embed: np.ndarray  # byte -> EMBED
    filters: np.ndarray  # BLOCK * EMBED -> first and second half of FILTERS
    bias: np.ndarray
    weight: np.ndarray  # mean and maximum of each filter -> logit
    offset: np.ndarray
    parts: list[str] = field(default_factory=lambda: ["embed", "filters", "bias", "weight", "offset"])

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(2 * BLOCK * EMBED)
        return cls(
            rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            rng.normal(0, scale, (BLOCK * EMBED, 2 * FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            np.zeros(2 * FILTERS, np.float32),
            np.zeros(1, np.float32),
        )


def chunks(data: bytes) -> np.ndarray:
    """Overlapping chunks over all of ``data``, one at least; code 256 fills the last one."""
    count = max(1, -(-(len(data) - (CHUNK - STEP)) // STEP))
    padded = np.full((count - 1) * STEP + CHUNK, 256, np.uint16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def responses(net: Network, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedded blocks from every byte on, filter responses by place, and each filter's largest (0 at least)."""
    flat = net.embed[codes].reshape(len(codes), CHUNK * EMBED)
    blocks = np.lib.stride_tricks.sliding_window_view(flat, BLOCK * EMBED, axis=1)[:, ::EMBED]
    blocks = np.ascontiguousarray(blocks)
    halves = (blocks.reshape(-1, BLOCK * EMBED) @ net.filters).reshape(*blocks.shape[:2], -1)
    at_place = halves[:, :-BLOCK, :FILTERS] + halves[:, BLOCK:, FILTERS:]
    at_place += net.bias
    return blocks, at_place, np.maximum(at_place.max(axis=1), 0)


def combine(pooled: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean and maximum over each document's chunks."""
    mean = np.add.reduceat(pooled, starts, axis=0) / counts[:, None]
    return np.concatenate([mean, np.maximum.reduceat(pooled, starts, axis=0)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gradients(net: Network, codes: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    blocks, at_place, pooled = responses(net, codes)
    features = combine(pooled, starts, counts)
    wrong = ((sigmoid(features @ net.weight + net.offset) - labels) / len(labels)).astype(np.float32)
    back = wrong[:, None] * net.weight
    owner = np.repeat(np.arange(len(counts)), counts)
    to_pool = back[owner, :FILTERS] / counts[owner, None]
    largest = pooled == features[owner, FILTERS:]
    to_pool = (to_pool + back[owner, FILTERS:] * largest) * (pooled > 0)
    place = at_place.argmax(axis=1)
    row = np.arange(len(codes))[:, None]
    halves = [(place, net.filters[:, :FILTERS]), (place + BLOCK, net.filters[:, FILTERS:])]
    to_filters = np.concatenate([np.einsum("nfk,nf->kf", blocks[row, at], to_pool) for at, _ in halves], axis=1)
    to_blocks = np.concatenate([to_pool[:, :, None] * part.T for _, part in halves]).reshape(-1, EMBED)
    windows = np.lib.stride_tricks.sliding_window_view(codes, BLOCK, axis=1)
    flat = np.concatenate([windows[row, at] for at, _ in halves]).ravel()
    to_embed = np.stack([np.bincount(flat, to_blocks[:, e], 257) for e in range(EMBED)], axis=1)
    return [to_embed, to_filters, to_pool.sum(axis=0), features.T @ wrong, wrong.sum(keepdims=True)]


def train(samples: list[tuple[np.ndarray, int]], steps: int = STEPS, seed: int = 7) -> Network:
    """Fit by Adam on (chunks, label) pairs. Without samples of both labels the score is 0.5."""
    net = Network.fresh(seed)
    if len({label for _, label in samples}) < 2:
        return net
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(getattr(net, p)) for p in net.parts]
    second = [np.zeros_like(getattr(net, p)) for p in net.parts]
    net.weight[:] = rng.normal(0, 0.3, 2 * FILTERS)
    order = np.concatenate([rng.permutation(len(samples)) for _ in range(1 + steps * BATCH // len(samples))])
    for step in range(1, steps + 1):
        rate = RATE * (1 - step / (steps + 1))
        batch = [samples[i] for i in order[(step - 1) * BATCH : step * BATCH]]
        gradients = _gradients(
            net,
            np.concatenate([c for c, _ in batch]),
            np.array([len(c) for c, _ in batch]),
            np.array([label for _, label in batch], np.float32),
        )
        for k, (part, g) in enumerate(zip(net.parts, gradients, strict=True)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            value = getattr(net, part)
            value -= (rate * move).astype(np.float32)
    return net


def scores(net: Network, texts: list[str | None]) -> np.ndarray:
    """Probabilities of whole texts; null counts as empty."""
    out = np.empty(len(texts))
    at = 0
    while at < len(texts):
        codes, counts, held, stop = [], [], 0, at
        while stop < len(texts) and held < SCORED_BYTES:
            data = (texts[stop] or "").encode()
            codes.append(chunks(data))
            counts.append(len(codes[-1]))
            held += len(data) + CHUNK
            stop += 1
        # a very long text is pooled part by part
        every = [c[k : k + SCORED_BYTES // CHUNK] for c in codes for k in range(0, len(c), SCORED_BYTES // CHUNK)]
        pooled, part, size = [], [], 0
        for c in every:
            part.append(c)
            size += len(c)
            if size >= SCORED_BYTES // CHUNK // 4:
                pooled.append(responses(net, np.concatenate(part))[2])
                part, size = [], 0
        if part:
            pooled.append(responses(net, np.concatenate(part))[2])
        number = np.array(counts)
        starts = np.concatenate([[0], np.cumsum(number)[:-1]])
        features = combine(np.concatenate(pooled), starts, number)
        out[at:stop] = sigmoid(features @ net.weight + net.offset)
        at = stop
    return out


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, int]]:
    """Chunks and labels of at most ``rows`` documents of each label, chosen by a hash of the id.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1). Repeated labels count once. Of the rows of a repeated id
    one is taken, that with the smallest chunks, before anything is collected. At most ``SAMPLE_CHUNKS`` chunks
    of a document leave its task, so the driver holds a bounded number of bytes.
    """
    first = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labels.where("doc_id is not null and label in (0, 1)")
        .select("doc_id", "label")
        .distinct()
        .withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= rows)
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    # at most two labels times ``rows`` ids
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for text in batch["text"]:
                every = chunks((text or "").encode())
                spread = np.linspace(0, len(every) - 1, min(SAMPLE_CHUNKS, len(every))).astype(int)
                parts.append(np.ascontiguousarray(every[spread]).tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "codes": parts})

    cuts = labelled.mapInPandas(cut, "doc_id long, label int, codes binary")
    found = cuts.groupBy("doc_id", "label").agg(F.min("codes").alias("codes")).collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"]))
    return [
        (np.frombuffer(bytes(r["codes"]), np.uint16).reshape(-1, CHUNK), r["label"]) for r in found
    ]


def quality_score(net: Network, text: Column) -> Column:
    """The probability of label 1 for each whole text."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(net, [t if isinstance(t, str) else None for t in texts]))

    return of(text)


def classify(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` up), in place of columns of those names.

    Only ``text`` is an input of the score. Null and empty texts are scored as one chunk of filling;
    every row of repeated ids or texts gets the same score. No rows give no rows.
    """
    scored = docs.withColumn("score", quality_score(net, F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
