"""Byte-level BPE with a queue of merge ranks, for rank files of the tiktoken form.

A text is cut by a pattern and each match is encoded by itself: the pair with the lowest rank is merged,
the leftmost of equal ones first, until no pair has a rank. A queue of ranks hands out the pairs, so a match of n
bytes takes about n log n steps, however long it is.
"""

from __future__ import annotations

import array
import base64
import math
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

WORD_BITS = 6
WORD = 1 << WORD_BITS
KNOWN_BYTES = 96 << 20  # of matches and ids that a worker remembers
LONGEST_KNOWN = 128  # characters; longer matches are encoded each time
LONGEST_TOGETHER = 64  # bytes; longer matches have a queue of their own
BLOCK = 1 << 19  # characters of a text that is cut at once
HELD = 1 << 19  # matches that are held at a time
KNOWN_COST = 250  # bytes of a remembered match
TEXT_BYTES = 4 << 20  # of the texts that are encoded together
OUTPUT_BYTES = 4 << 20


class RankQueue:
    """Positions by rank. Each rank has a bucket; a bitmap over the buckets that hold something has a bitmap over
    its words that are not zero, and so on up to one word, so the lowest rank is found by one find-first-set
    a level. A bucket is a heap: it gives out its leftmost position first."""

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.levels: list[list[int]] = []
        words = ranks
        while not self.levels or words > 1:
            words = max(1, math.ceil(words / WORD))
            self.levels.append([0] * words)

    def mark(self, rank: int) -> None:
        """The rank's bucket now holds something."""
        at = rank
        for level in self.levels:
            bit = 1 << (at & (WORD - 1))
            at >>= WORD_BITS
            before = level[at]
            level[at] = before | bit
            if before:
                return

    def clear(self, rank: int) -> None:
        """The rank's bucket is now empty."""
        at = rank
        for level in self.levels:
            bit = 1 << (at & (WORD - 1))
            at >>= WORD_BITS
            level[at] &= ~bit
            if level[at]:
                return

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            self.mark(rank)
        heappush(bucket, position)

    def lowest(self) -> int | None:
        """The lowest rank whose bucket holds something."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return None
            at = (at << WORD_BITS) | ((word & -word).bit_length() - 1)
        return at


class BytePairs:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} lacks the bytes {missing}")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.queue = RankQueue(max(self.tokens) + 1)
        self.pattern = regex.compile(pattern)
        self.pairs, self.pair_ranks = self._pair_table()
        self.byte_ranks = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tokens that are a token together, as sorted numbers, and that token's ranks."""
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        # one entry more, so that every place that a search returns can be looked at
        return np.append(np.array(pairs, np.int64)[order], -1), np.append(np.array(merged, np.int32)[order], 0)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 for none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs[:-1], wanted)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], -1)

    def merge_many(self, matches: list[bytes]) -> list[bytes]:
        """Ids of the bytes of many short matches, which share the queue and never meet.

        A bucket is worked off as one array: of each match the leftmost position, the others come again. New pairs
        wait until all lower ranks of their word of the bitmap are done, and are then put into their buckets
        together.
        """
        data = b"".join(matches)
        n = len(data)
        sizes = np.fromiter(map(len, matches), np.int32, len(matches))
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        match_of = np.repeat(np.arange(len(matches), dtype=np.int32), sizes)
        first = np.zeros(n + 1, bool)
        first[starts] = first[n] = True
        token = self.byte_ranks[np.frombuffer(data, np.uint8)]
        # a token is known by the place of its first byte; after[i] is the place of the next token
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        pair = np.full(n, -1, np.int32)  # the rank of the pair that starts there
        pair[:-1] = np.where(first[1:-1], -1, self._rank_of(token[:-1], token[1:]))
        queue, buckets = self.queue, {}

        def put(places: np.ndarray) -> None:
            """Ascending places into the buckets of their pairs."""
            ranks = pair[places]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            ends = np.append(cuts, len(ranks))[1:]
            for rank, start, end in zip(ranks[cuts].tolist(), cuts.tolist(), ends.tolist(), strict=True):
                if rank in buckets:
                    buckets[rank].append(places[start:end])
                else:
                    buckets[rank] = [places[start:end]]
                    queue.mark(rank)

        waiting = [np.flatnonzero(pair >= 0).astype(np.int32)]
        limit = 0  # ranks that wait are no lower
        while True:
            rank = queue.lowest()
            if rank is None or rank >= limit:
                places = np.unique(np.concatenate([np.zeros(0, np.int32), *waiting]))
                waiting = []
                put(places[pair[places] >= 0])
                rank = queue.lowest()
                if rank is None:
                    break
                limit = ((rank >> WORD_BITS) + 1) << WORD_BITS
            parts = buckets.pop(rank)
            queue.clear(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[pair[at] == rank]  # the others are stale: their tokens were merged meanwhile
            if not len(at):
                continue
            of = match_of[at]
            again = np.flatnonzero(of[1:] == of[:-1]) + 1
            if len(again):
                buckets[rank] = [at[again]]
                queue.mark(rank)
                at = np.delete(at, again)
            gone = after[at]
            end = after[gone]
            after[at] = end
            before[end] = at
            token[at] = rank
            pair[gone] = -1
            pair[at] = -1
            left = before[at[~first[at]]]
            inner = ~first[end]
            followed, following = at[inner], end[inner]
            pair[left] = self._rank_of(token[left], token[after[left]])
            pair[followed] = self._rank_of(token[followed], token[following])
            new = np.concatenate([left, followed])
            ranks = pair[new]
            waiting.append(new[ranks >= limit])
            now = new[(ranks >= 0) & (ranks < limit)]
            if len(now):
                put(np.sort(now))
        is_token = np.zeros(n, bool)
        at = starts
        while len(at):
            is_token[at] = True
            at = after[at]
            at = at[~first[at]]
        ids = token[is_token].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.add.reduceat(is_token, starts, dtype=np.int64))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_one(self, data: bytes) -> list[int]:
        """Ids of the bytes of one match."""
        n = len(data)
        rank_of, queue = self.ranks.get, self.queue
        after, before = list(range(1, n + 1)), list(range(-1, n))
        pair = [-1] * n
        for i in range(n - 1):
            if (rank := rank_of(data[i : i + 2])) is not None:
                pair[i] = rank
                queue.push(rank, i)
        while (lowest := queue.lowest()) is not None:
            bucket = queue.buckets[lowest]
            i = heappop(bucket)
            if not bucket:
                queue.clear(lowest)
            if pair[i] != lowest:
                continue  # stale
            gone = after[i]
            end = after[gone]
            after[i] = end
            before[end] = i
            pair[gone] = pair[i] = -1
            if end < n and (rank := rank_of(data[i : after[end]])) is not None:
                pair[i] = rank
                queue.push(rank, i)
            if i > 0:
                left = before[i]
                rank = rank_of(data[left:end])
                pair[left] = -1 if rank is None else rank
                if rank is not None:
                    queue.push(rank, left)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[data[i : after[i]]])
            i = after[i]
        return ids

    def _learn(self, matches: set[str]) -> None:
        """Remember the ids of matches that are not known."""
        known, rank_of = self.known, self.ranks.get
        short: dict[str, bytes] = {}
        for match in matches:
            data = match.encode()
            if data in self.ranks:
                known[match] = array.array("I", (rank_of(data),)).tobytes()
            elif len(data) > LONGEST_TOGETHER:
                known[match] = array.array("I", self.merge_one(data)).tobytes()
            else:
                short[match] = data
        if short:
            known.update(zip(short, self.merge_many(list(short.values())), strict=True))
        self.held += KNOWN_COST * len(matches)

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= BLOCK:
            yield self.pattern.findall(text)
            return
        matches = (m.group() for m in self.pattern.finditer(text))
        while block := list(islice(matches, BLOCK // 4)):
            yield block

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        coded: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for matches in self._matches(text):
                held.append((i, matches))
                size += len(matches)
                if size >= HELD:
                    self._encode_held(held, coded)
                    size = 0
        self._encode_held(held, coded)
        return [b"".join(parts) for parts in coded]

    def _encode_held(self, held: list[tuple[int, list[str]]], coded: list[list[bytes]]) -> None:
        """Append the ids of the matches of texts, all new ones merged together."""
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        new = set(chain.from_iterable(matches for _, matches in held)).difference(self.known)
        self._learn(new)
        for i, matches in held:
            coded[i].append(b"".join(map(self.known.__getitem__, matches)))
        for match in [m for m in new if len(m) > LONGEST_KNOWN]:
            del self.known[match]
        held.clear()

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except KeyError as unknown:
            raise ValueError(f"no token has the id {unknown}") from None


@cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One per worker, file and pattern."""
    return BytePairs(path, pattern)


def _in_parts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` of every whole text of ``docs`` (``doc_id``, ``text``; further columns are ignored).

    ``path`` names a rank file that all executors can read. A null or empty text has no ids. Rows that repeat and
    null ids are kept as they are; no rows give no rows. A task holds the matches of one block of a text at a time, the
    text and its ids; one match needs about 50 bytes a byte while it is merged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        for batch in batches:
            doc_id, texts = batch.column("doc_id"), batch.column("text")
            for start, end in _in_parts(pc.binary_length(texts).fill_null(0).to_pylist(), TEXT_BYTES):
                coded = coder.encode([t or "" for t in texts[start:end].to_pylist()])
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(coded))])
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([doc_id.slice(start, end - start), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``coded`` (``doc_id``, ``ids``) with the ``bytes`` that the ids stand for; further columns are ignored.

    Null ids give null bytes and no ids give empty bytes. An id that the file lacks is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        for batch in batches:
            ids = batch.column("ids")
            sizes = ids.value_lengths().fill_null(0).to_pylist()
            flat, at = ids.flatten().to_numpy(zero_copy_only=False), 0
            for start, end in _in_parts([4 * n for n in sizes], OUTPUT_BYTES):
                part, found = batch.slice(start, end - start), []
                for known, size in zip(part.column("ids").is_valid().to_pylist(), sizes[start:end], strict=True):
                    found.append(coder.decode(flat[at : at + size].tolist()) if known else None)
                    at += size
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(found, pa.binary())], ["doc_id", "ids", "bytes"]
                )

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, bytes binary")
