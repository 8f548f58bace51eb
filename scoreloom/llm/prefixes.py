"""Document fingerprints from modular prefix hashes.

A text is a polynomial in its code points, taken modulo the prime 2**31 - 1 at two bases. With the
array of its prefixes, the hash of any span is one subtraction and one product, so equal spans are
found wherever they lie, and the longest common extension of two places by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
MASK, SHIFT = np.uint64(PRIME), np.uint64(31)
BASES = (911_382_323, 972_663_749)
BLOCK = 1 << 16  # code points whose prefixes are in memory at once
WINDOW = 12  # code points of the spans that a sketch is made of
SLOTS = 64  # a sketch keeps the smallest span hash of each slot
SLOT_BITS, EMPTY = 6, 0xFFFFFFFF  # a slot without a span


def _reduce(x: np.ndarray) -> np.ndarray:
    """``x`` below 2**62 modulo the prime. A difference below zero wraps to a large number."""
    y = x >> SHIFT
    y += x & MASK
    np.minimum(y, y - MASK, out=y)
    return np.minimum(y, y - MASK, out=y)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:  # doubling: known powers times the next one
        step = np.uint64(pow(base, done, PRIME))
        more = min(done, count - done)
        out[done : done + more] = _reduce(out[:more] * step)
        done += more
    return out


NO_SPAN = np.uint64((1 << 64) - 1)  # above every hash without its slot bits
POWERS = [_powers(b, BLOCK + WINDOW) for b in BASES]
INVERSES = [_powers(pow(b, -1, PRIME), BLOCK + WINDOW) for b in BASES]


class Prefixes:
    """Prefix arrays of up to ``BLOCK + WINDOW`` code points."""

    def __init__(self, codes: np.ndarray):
        self.sums = []
        for powers in POWERS:
            terms = _reduce((codes.astype(np.uint64) + 1) * powers[: len(codes)])
            self.sums.append(np.concatenate([[np.uint64(0)], _reduce(np.cumsum(terms))]))

    def spans(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        """Hashes of the spans; equal spans have equal hashes, wherever they start."""
        whole = np.uint64(0)
        for sums, inverse in zip(self.sums, INVERSES, strict=True):
            part = sums[end] - sums[start]
            np.minimum(part, part + MASK, out=part)
            part *= inverse[start]
            whole = (whole << SHIFT) | _reduce(part)
        return whole

    def span(self, start: int, end: int) -> int:
        """The hash of one span."""
        whole = 0
        for sums, inverse in zip(self.sums, INVERSES, strict=True):
            part = (int(sums[end]) - int(sums[start])) * int(inverse[start]) % PRIME
            whole = whole << 31 | part
        return whole


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def common_extension(a: Prefixes, b: Prefixes, at_a: int, at_b: int, most: int) -> int:
    """Length of the longest equal span from the two places, ``most`` at most."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(at_a, at_a + middle) == b.span(at_b, at_b + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _stored(smallest: np.ndarray) -> np.ndarray:
    """32 bits per slot that tell its smallest hash; small hashes differ in all of them. Never ``EMPTY`` if filled."""
    mixed = _mix(smallest * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return np.where(smallest == NO_SPAN, np.uint64(EMPTY), np.minimum(mixed, np.uint64(EMPTY - 1)))


class Marked:
    """A text's code points, block hashes, fingerprint, and the prefixes of its last block."""

    def __init__(self, text: str):
        self.codes = codes_of(text)
        self.blocks: list[int] = []
        self.last: tuple[int, Prefixes] | None = None
        whole = [0] * len(BASES)
        slots = np.full(SLOTS, NO_SPAN, np.uint64)
        count, size = len(self.codes), min(WINDOW, len(self.codes))
        for at in range(0, count, BLOCK):
            part = Prefixes(self.codes[at : at + BLOCK + WINDOW - 1])
            own = min(BLOCK, count - at)
            self.last = at, part
            self.blocks.append(part.span(0, own))
            for k, base in enumerate(BASES):
                whole[k] = (whole[k] + int(part.sums[k][own]) * pow(base, at, PRIME)) % PRIME
            spans = min(own, count - at - size + 1)
            if spans > 0:
                hashes = _mix(part.spans(slice(0, spans), slice(size, size + spans)))
                slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                np.minimum.at(slots, slot, hashes & np.uint64((1 << (64 - SLOT_BITS)) - 1))
        sketch = _stored(slots).astype(">u4").tobytes().hex()
        self.print = f"{count:x}-{whole[0]:08x}{whole[1]:08x}-{sketch}"

    def prefixes(self, at: int) -> Prefixes:
        """Of the block that starts there."""
        if self.last and self.last[0] == at:
            return self.last[1]
        return Prefixes(self.codes[at : at + BLOCK])


def fingerprint(text: str) -> str:
    """Length, hash of the whole text, and a sketch of its spans, in hexadecimal.

    The spans are all of ``WINDOW`` code points, or the whole of a shorter text. A slot is chosen by six bits
    of a span's hash and keeps 32 bits made from the smallest of the other 58, so unrelated texts of any
    length rarely agree. Slots without a span hold ``ffffffff``.
    """
    return Marked(text).print


def common_prefix(a: Marked, b: Marked) -> int:
    """Length of the longest common prefix: whole blocks by their hashes, then a binary search."""
    most = min(len(a.codes), len(b.codes))
    for k, at in enumerate(range(0, most, BLOCK)):
        size = min(BLOCK, most - at)
        same_size = min(len(a.codes), at + BLOCK) == min(len(b.codes), at + BLOCK)
        if not same_size or a.blocks[k] != b.blocks[k]:
            return at + common_extension(a.prefixes(at), b.prefixes(at), 0, 0, size)
    return most


def likeness(a: str, b: str) -> float:
    """Equal slots as a share of the slots that either fingerprint fills; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition("-")[2]), ">u4") for f in (a, b))
    filled = (x != EMPTY) | (y != EMPTY)
    return float(((x == y) & filled).sum() / max(1, filled.sum()))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the following text's beginning."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows sorted into partitions by ``doc_id``, each partition ending with the next one's first row.

    The bounds are values of ``doc_id``, so every partition has rows; there are fewer bounds than shuffle
    partitions. The copied rows have ``tail`` set. The last partition ends with the first row of all.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    places = [i / count for i in range(1, count)] or [0.5]
    ids = rows.agg(
        F.min("doc_id").alias("low"),
        F.max(F.col("doc_id").isNull()).alias("nulls"),
        F.percentile_approx("doc_id", places, max(10_000, 20 * count)).alias("bounds"),
    ).first()
    bounds = np.array(sorted(set(ids["bounds"] or []) - (set() if ids["nulls"] else {ids["low"]})), np.int64)

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        known = keys.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(bounds, known, side="right").astype("int32"))

    @F.pandas_udf("boolean")
    def starts_part(keys: pd.Series) -> pd.Series:
        return keys.isin(bounds)

    first = F.col("doc_id").isNull() if ids["nulls"] else F.col("doc_id") == F.lit(ids["low"])
    heads = rows.where(starts_part("doc_id") | first).groupBy("doc_id").agg(F.min("text").alias("text"))
    before = F.when(first, len(bounds)).otherwise(part_of("doc_id") - 1)
    dealt = rows.select("*", F.lit(False).alias("tail"), part_of("doc_id").alias("part")).union(
        heads.select("*", F.lit(True).alias("tail"), before.alias("part"))
    )
    order = ["tail", F.asc_nulls_first("doc_id"), "text"]
    return dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(*order)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they are.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. The edited text has the last
    ``floor(n_chars / 4)`` code points replaced by as many from the beginning of the next document in order
    of ``doc_id`` (null first, ties by text; the first after the last). ``common_prefix`` is the length that a
    text shares with its edited text. A null text counts as empty; an empty text has no spans, equals
    other empty texts and is unlike all others. Repeated rows are documents of their own. A single
    document is its own next one. No rows give no rows.

    Texts move once, into ranges of ids; a task holds two texts and the prefixes of one block.
    """
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "tail"))
            for key, text, tail in zip(*columns, strict=True):
                marked = Marked(text)
                if held:
                    own_key, own_text, own = held
                    changed_text = edited(own_text, text)
                    changed = Marked(changed_text)
                    rows.append((
                        own_key, len(own.codes), hashlib.sha256(changed_text.encode()).hexdigest(),
                        own.print, changed.print, likeness(own.print, changed.print),
                        likeness(own.print, marked.print), common_prefix(own, changed),
                    ))
                held = None if tail else (key, text, marked)
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), schema=SCHEMA)

    return _with_next(docs).select("doc_id", "text", "tail").mapInArrow(run, RESULT)


SCHEMA = pa.schema(
    [(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[k]) for n, k in (x.split() for x in RESULT.split(", "))]
)
