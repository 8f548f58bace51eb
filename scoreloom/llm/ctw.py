"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions. Every decision has a context tree over the bytes before: a node
estimates the decision by Krichevsky-Trofimov from the training counts, and mixes its estimate with
its children's, with the weight that the training data give it. The code length of a byte is the sum
of its decisions' over that mixture.

All the model needs are counts of (context, byte). They are counted in blocks of documents, added up
over the corpus in buckets of contexts, turned into a log probability per (context, byte), and sent
back to the blocks that ask for them. A task holds one block, or the distinct keys of one bucket; keys
travel as compressed sorted arrays.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish

DEPTH = 5  # bytes of context
EDGE = 0xFF  # stands before and after a text; no byte of UTF-8
BLOCK_BYTES = 1 << 23  # bytes of the words of a block; a longer text is a block of its own
OWNER_BITS = 8 * (7 - DEPTH)  # what a key leaves of 64 bits for a text's number
PLACE_BITS = 33  # of a block's number in its partition
PART_BYTES = 1 << 21  # bytes of text whose keys are sorted at once
HALF = math.log(0.5)


def tokens(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) words between ASCII white space."""
    return (text or "").encode().lower().split()


def context_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and each text's end: the bytes before, the nearest first, then the byte; and the
    text's number."""
    edge = bytes([EDGE])
    data = np.frombuffer(b"".join(edge * DEPTH + t + edge for t in texts), np.uint8)
    size = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    key = np.zeros(len(data) - DEPTH, np.uint64)
    for back in range(1, DEPTH + 1):
        key |= data[DEPTH - back : len(data) - back]
        key <<= np.uint64(8)
    key |= data[DEPTH:]
    # keys of the places where a later text's edges stand are left out
    coded = np.ones(len(key), bool)
    first = np.cumsum(size[:-1] + DEPTH)
    coded[(first[:, None] - np.arange(DEPTH)[None, :] - 1).ravel()] = False
    return key[coded], owner


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, int)


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PART_BYTES``, as many as a key can number at most."""
    start = held = 0
    for n, text in enumerate(texts):
        held += len(text) + DEPTH + 1
        if held >= PART_BYTES or n + 1 - start >= 1 << OWNER_BITS:
            yield start, n + 1
            start, held = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


BLOCKS = "block long, doc_ids array<long>, learn array<boolean>, words binary"
KEYS = "word boolean, block long, bucket int, keys binary, n binary"


def packed(values: np.ndarray) -> bytes:
    """An array as compressed byte planes; ``unpacked`` is the way back."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every, value = every[order], np.concatenate(values)[order]
    starts = _runs(every)
    return every[starts], np.add.reduceat(value, starts) if len(starts) else value


def word_key(word: bytes) -> int:
    """Words are joined by this 64-bit hash; two of a billion words share one with a chance of 3 %."""
    return xxhash.xxh64_intdigest(word)


def bucket_of(keys: np.ndarray, word: bool, buckets: int) -> np.ndarray:
    """Keys whose contexts share the two nearest bytes have the same bucket."""
    near = keys if word else keys >> np.uint64(8 * (DEPTH - 1))
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)


def text_blocks(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id``, ``text``, ``learn`` as blocks: ids, and the texts' words joined and compressed.

    The blocks are numbered within their partition, so the result must be stored before it is read twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << PLACE_BITS
        ids, learn, texts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            words = zstandard.compress(bytes([EDGE]).join(texts), 3)
            row = {"block": number, "doc_ids": ids, "learn": learn, "words": words}
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in batches:
            for key, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "learn")), strict=True):
                joined = b" ".join(tokens(text))
                if texts and held + len(joined) > BLOCK_BYTES:
                    yield block()
                    number += 1
                    ids, learn, texts, held = [], [], [], 0
                ids.append(key)
                learn.append(own)
                texts.append(joined)
                held += len(joined) + DEPTH + 1
        if texts:
            yield block()

    return docs.select("doc_id", "text", "learn").mapInArrow(run, BLOCKS)


BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("learn", pa.list_(pa.bool_())),
        ("words", pa.binary()),
    ]
)


def texts_of(words: bytes) -> list[bytes]:
    """The texts of a block."""
    return zstandard.decompress(words).split(bytes([EDGE]))


def _by_bucket(keys: np.ndarray, word: bool, buckets: int) -> list[np.ndarray]:
    """For each bucket, the places of its keys in a block's sorted keys."""
    bucket = bucket_of(keys, word, buckets)
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


def _block_keys(block: int, texts: list[bytes], learn: list[bool], buckets: int) -> Iterator[dict]:
    """What a block's texts hold, and how often its training texts do, by bucket."""
    counts: Counter = Counter()
    others: set = set()
    for text, own in zip(texts, learn, strict=True):
        counts.update(text.split()) if own else others.update(text.split())
    keys, values = [], []
    for start, end in _parts(texts):
        part, owner = context_keys(texts[start:end])
        part <<= np.uint64(1)
        part |= np.array(learn[start:end], np.uint64)[owner]
        part.sort()
        learnt = (part & np.uint64(1)).astype(np.int64)
        part >>= np.uint64(1)
        starts = _runs(part)
        values.append(np.add.reduceat(learnt, starts))
        keys.append(part[starts])
    words = list(counts) + list(others - counts.keys())
    hashed = np.array(list(map(word_key, words)), np.uint64)
    seen = np.array([*counts.values(), *[0] * (len(words) - len(counts))], np.int64)
    for word, found in ((False, (keys, values)), (True, ([hashed], [seen]))):
        each, n = summed(*found)
        for bucket, own in enumerate(_by_bucket(each, word, buckets)):
            if len(own):
                yield {
                    "word": word, "block": block, "bucket": bucket,
                    "keys": packed_keys(each[own]), "n": packed(n[own]),
                }


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size > most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in text.split(", "))])


def block_keys(blocks: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket, the (context, byte) keys and the words with their training counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _block_keys(row["block"], texts_of(row["words"]), row["learn"], buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), _schema(KEYS))

    return blocks.select("block", "learn", "words").mapInArrow(run, KEYS)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For ``x`` of 1/2 and more, by Stirling's series from ``x + 8`` on."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


class Level:
    """The decisions at one depth for one bit of the byte: counts, and how much they are trusted."""

    def __init__(self, node: np.ndarray, bit: np.ndarray, n: np.ndarray, below: Level | None):
        starts = _runs(node)
        self.node = node[starts]
        total = np.add.reduceat(n, starts)
        self.ones = np.add.reduceat(n * bit, starts)
        self.zeros = total - self.ones
        estimate = kt(self.zeros, self.ones)
        if below is None:
            self.weighted, self.stop = estimate, np.ones(len(estimate))
        else:
            parent = np.searchsorted(self.node, ((below.node >> 16) << 8) | (below.node & 255))
            children = np.bincount(parent, below.weighted, len(self.node))
            self.weighted = np.logaddexp(HALF + estimate, HALF + children)
            self.stop = np.exp(HALF + estimate - self.weighted)

    def mix(self, node: np.ndarray, bit: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of each decision, given that of the next depth."""
        at = np.searchsorted(self.node, node)
        own = (np.where(bit == 1, self.ones[at], self.zeros[at]) + 0.5) / (self.ones[at] + self.zeros[at] + 1)
        return own if deeper is None else self.stop[at] * own + (1 - self.stop[at]) * deeper


def _decision(symbol: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """The place in the byte's tree (1 to 255) and the bit taken there."""
    return (1 << bit) | (symbol >> (8 - bit)), (symbol >> (7 - bit)) & 1


def _subtrees(grams: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, list[Level], list[np.ndarray], np.ndarray]]:
    """For each bit, the levels from ``DEPTH`` up to 2, with each key's node there, and the bit taken."""
    symbol = grams & 255
    for bit in range(8):
        place, taken = _decision(symbol, bit)
        levels: list[Level] = []
        nodes = []
        for depth in range(DEPTH, 1, -1):
            node = ((grams >> (8 * (DEPTH - depth + 1))) << 8) | place
            order = np.argsort(node, kind="stable")
            levels.append(Level(node[order], taken[order], n[order], levels[-1] if levels else None))
            nodes.append(node)
        yield bit, levels, nodes, taken


def _top_sums(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What a bucket of subtrees adds to the nodes of depth 1: context, place, zeros, ones, and the sum of
    the weighted probabilities below, in rows."""
    out = []
    for _, levels, _, _ in _subtrees(grams, n):
        top = levels[-1]
        key = ((top.node >> 16) << 8) | (top.node & 255)
        own, at = np.unique(key, return_inverse=True)
        sums = [np.bincount(at, v) for v in (top.zeros, top.ones, top.weighted)]
        out.append(np.stack([own >> 8, own & 255, *sums], axis=1))
    return np.concatenate(out)


class Top:
    """The nodes of depths 1 and 0: 256 contexts and one, times 256 places, whatever the corpus."""

    def __init__(self, rows: list):
        self.zeros, self.ones = np.zeros((257, 256)), np.zeros((257, 256))
        below = np.zeros((257, 256))
        for c1, place, zeros, ones, weighted in rows:
            self.zeros[c1, place], self.ones[c1, place], below[c1, place] = zeros, ones, weighted
        self.zeros[256], self.ones[256] = self.zeros[:256].sum(axis=0), self.ones[:256].sum(axis=0)
        estimate = kt(self.zeros, self.ones)
        weighted = np.logaddexp(HALF + estimate, HALF + below)
        below[256] = weighted[:256].sum(axis=0)
        weighted[256] = np.logaddexp(HALF + estimate[256], HALF + below[256])
        self.stop = np.exp(HALF + estimate - weighted)

    def mix(self, c1: np.ndarray, place: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        for context in (c1, np.full_like(c1, 256)):
            zeros, ones, stop = (t[context, place] for t in (self.zeros, self.ones, self.stop))
            own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            deeper = stop * own + (1 - stop) * deeper
        return deeper


def _log_probabilities(grams: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """Log10 probability of each key's byte after its context."""
    total = np.zeros(len(grams))
    c1 = grams >> (8 * DEPTH)
    for bit, levels, nodes, taken in _subtrees(grams, n):
        p = None
        for level, node in zip(levels, nodes, strict=True):
            p = level.mix(node, taken, p)
        total += np.log10(top.mix(c1, _decision(grams & 255, bit)[0], taken, p))
    return total


MODEL = "word boolean, bucket int, keys binary, n binary, top binary, total long, known long"
ANSWERS = "block long, word boolean, bucket int, answers binary"
MERGE = 1 << 23  # keys that are held before they are added up


def model(keys: DataFrame, buckets: int) -> DataFrame:
    """Per bucket, the distinct keys of the corpus with their training counts, in one row.

    A task takes one bucket, whose blocks stream by; what it holds are the bucket's distinct keys. For
    contexts ``top`` has the sums for the nodes of depth 1; for words ``total`` and ``known`` count training tokens
    and words.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[tuple[bool, int], list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = held.setdefault((row["word"], row["bucket"]), [[], [], 0])
                own[0].append(unpacked_keys(row["keys"]))
                own[1].append(unpacked(row["n"], np.int64))
                own[2] += len(own[0][-1])
                if own[2] > MERGE + 2 * len(own[0][0]):
                    merged = summed(own[0], own[1])
                    own[:] = [[merged[0]], [merged[1]], len(merged[0])]
        for (word, bucket), (every, values, _) in held.items():
            own, n = summed(every, values)
            top = b"" if word else _top_sums(own.astype(np.int64), n).tobytes()
            yield {
                "word": word, "bucket": bucket, "keys": packed_keys(own), "n": packed(n), "top": top,
                "total": int(n.sum()), "known": int((n > 0).sum()),
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), _schema(MODEL))

    return keys.repartitionById(buckets, F.col("bucket")).mapInArrow(run, MODEL)


def top_nodes(models: DataFrame) -> Top:
    """The nodes of depths 0 and 1, added up over the buckets: 256 contexts and one, 256 places."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("top").to_pylist():
                part = np.frombuffer(data, np.float64).reshape(-1, 5)
                columns = [part[:, 0].astype(np.int32), part[:, 1].astype(np.int32), *part[:, 2:].T]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    kind = "c1 int, place int, zeros double, ones double, below double"
    names = [x.split()[0] for x in kind.split(", ")]
    sums = models.where("not word").select("top").mapInArrow(rows, kind)
    added = sums.groupBy("c1", "place").agg(F.sum("zeros"), F.sum("ones"), F.sum("below"))
    return Top([tuple(r) for r in added.collect()])


def answers(keys: DataFrame, models: DataFrame, top: Top, buckets: int) -> DataFrame:
    """For every block's keys, in their order, the model's answers: log10 probabilities, or training counts
    of words."""
    asked = keys.select("word", "bucket", F.lit(True).alias("asks"), "block", "keys", F.lit(None).cast("binary").alias("n"))
    known = models.select("word", "bucket", F.lit(False).alias("asks"), F.lit(None).cast("long").alias("block"), "keys", "n")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at = own = value = None
        for batch in batches:
            for row in batch.to_pylist():
                each = unpacked_keys(row["keys"])
                if not row["asks"]:
                    at, own, value = (row["word"], row["bucket"]), each, unpacked(row["n"], np.int64)
                    if not row["word"]:
                        value = _log_probabilities(each.astype(np.int64), value, top).astype(np.float32)
                    continue
                place = np.searchsorted(own, each)
                if at != (row["word"], row["bucket"]) or not np.array_equal(own[place], each):
                    raise ValueError("a block asks for keys that were not counted")
                yield {
                    "block": row["block"], "word": row["word"], "bucket": row["bucket"],
                    "answers": packed(value[place]),
                }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), _schema(ANSWERS))

    dealt = known.union(asked).repartitionById(buckets, F.col("bucket"))
    return dealt.sortWithinPartitions("word", "bucket", "asks").mapInArrow(run, ANSWERS)


SCORES = "doc_id long, n_bytes long, n_tokens long, n_known long, base_log double, score double"


def _answered(keys: np.ndarray, found: pa.Table, word: bool, kind: type, buckets: int) -> np.ndarray:
    """The answers to a block's sorted keys."""
    own = found.filter(pa.compute.equal(found.column("word"), word))
    places = _by_bucket(keys, word, buckets)
    out, answered = np.zeros(len(keys), kind), 0
    for bucket, data in zip(own.column("bucket").to_pylist(), own.column("answers").to_pylist(), strict=True):
        value = unpacked(data, kind)
        out[places[bucket]] = value
        answered += len(value)
    if answered != len(keys):
        raise ValueError("a block's answers do not match its keys")
    return out


def _score_block(docs: pa.Table, found: pa.Table, end_count: int, buckets: int) -> pa.Table:
    row = docs.to_pylist()[0]
    texts = texts_of(row["words"])
    every = list(set().union(*(t.split() for t in texts)))
    hashed = np.array(list(map(word_key, every)), np.uint64)
    distinct = np.unique(hashed)
    times = _answered(distinct, found, True, np.int64, buckets)[np.searchsorted(distinct, hashed)]
    counts = dict(zip(every, times.tolist(), strict=True))
    tokens_of, known, base = [], [], []
    for text in texts:
        words = text.split()
        n = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
        tokens_of.append(len(words) + 1)
        known.append(int((n > 0).sum()) + (end_count > 0))
        base.append(float(np.log10(n + 1.0).sum()) + math.log10(end_count + 1))

    runs = []
    for start, end in _parts(texts):
        keys, owner = context_keys(texts[start:end])
        keys <<= np.uint64(OWNER_BITS)
        keys |= owner.astype(np.uint64)
        keys.sort()
        starts = _runs(keys)  # of one key in one text
        times = np.diff(starts, append=len(keys)).astype(np.int32)
        keys = keys[starts]
        text = (keys & np.uint64((1 << OWNER_BITS) - 1)).astype(np.int32) + start
        keys >>= np.uint64(OWNER_BITS)
        starts = _runs(keys)
        runs.append((keys[starts], np.diff(starts, append=len(keys)), text, times))
    grams = np.sort(np.concatenate([each for each, _, _, _ in runs]))
    grams = grams[_runs(grams)]
    log10p = _answered(grams, found, False, np.float32, buckets).astype(np.float64)
    score = np.zeros(len(texts))
    for each, texts_with, text, times in runs:
        weights = np.repeat(log10p[np.searchsorted(grams, each)], texts_with)
        weights *= times
        score += np.bincount(text, weights, len(texts))
    return pa.table(
        {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array(tokens_of, pa.int64()),
            "n_known": pa.array(known, pa.int64()),
            "base_log": pa.array(base, pa.float64()),
            "score": pa.array(score),
        }
    )


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """One row per document with the model's log10 probability of its whole text.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. ``learn`` says which rows the model learns
    from; null counts as false. What is scored is the lower-case (A-Z) words with one space between
    and the end of the text. Returns ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
    and ``bits_per_byte`` (code length per byte, the end counted as one).

    ``base_score`` is that of a word model: the sum over words and the end of
    ``log10((c + 1) / (N + V + 1))`` with the training count ``c``, all tokens ``N`` and distinct tokens ``V``.

    A null or empty text, or one of white space, is its end only. Without training rows every
    decision has the probability 1/2, and N and V are 0. Repeated rows and null ids are ordinary
    rows. No rows give no rows.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    learns = F.coalesce(learn, F.lit(False)).alias("learn")
    blocks = publish(text_blocks(docs.select("doc_id", "text", learns)), "ctw-blocks")
    keys = publish(block_keys(blocks, buckets), "ctw-keys")
    models = publish(model(keys, buckets), "ctw-model")
    words = models.where("word").agg(F.sum("total").alias("n"), F.sum("known").alias("v")).first()
    learnt = F.size(F.filter("learn", lambda own: own))
    ends = blocks.agg(F.sum(learnt)).first()[0] or 0
    total, distinct = (words["n"] or 0) + ends, (words["v"] or 0) + (ends > 0)
    replies = answers(keys, models, top_nodes(models), buckets)

    def score_block(texts: pa.Table, found: pa.Table) -> pa.Table:
        return _score_block(texts, found, ends, buckets)

    scored = (
        blocks.select("block", "doc_ids", "words")
        .groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(score_block, SCORES)
    )
    per_token = math.log10(total + distinct + 1)
    return scored.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_log") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
