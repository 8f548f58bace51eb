"""Hierarchical packing of tokenised documents into sequences of several lengths.

A document's whole windows of the longest length are sequences of their own; what is left is routed to
the smallest tier that holds it. Every tier is packed from its longest piece down, and the gap of a
window is filled from the shorter tiers, best fit first, cutting a piece where none fits. Sequences
have a tier's length exactly, but for the last one of a cell. Step groups of a cell get equal shares
of attention cost.
"""

from __future__ import annotations

import array
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (2048, 1024, 512, 256)
END_ID = 1
ID_BYTES = 4
CELL_TOKENS = 1 << 21  # tokens that are packed together; bounds the memory of a task
STEP_TOKENS = 1 << 16  # tokens of a step group
KNOWN_WORDS = 600_000  # words whose ids a worker remembers
PLACE_BITS = 33  # of a sequence's id: its number in its partition, below the partition's

RUNS = re.compile(r"[a-zß-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")  # letters; signs but the apostrophe
PLAIN = re.compile(f"(?:{RUNS.pattern})+")
LETTERS = re.compile(r"^[a-zß-öø-ÿ]+$", re.MULTILINE)  # a line that is one run of letters
JOINED = 200  # runs that are encoded together

Piece = tuple[int, int, int]  # length, document's place in the cell, start

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers, remembered by word.

    The tokenizer drops white space and never joins across it, so a text's ids are the ids of
    the parts between its spaces. Case is dropped as well, so words within Latin-1 are
    remembered in lower case. A word of letters and signs is cut where they meet, as the
    tokenizer cuts it; such runs are encoded many at a time and told apart by the tokens that end
    a word. Texts with a special token are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, parts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array.array("I", x.ids).tobytes() for x in coded]

    def _encode_runs(self, runs: list[str]) -> list[bytes]:
        data = b"".join(self._encode([" ".join(runs[at : at + JOINED]) for at in range(0, len(runs), JOINED)]))
        ends = (np.flatnonzero(self.ends_word[np.frombuffer(data, np.uint32)]) + 1) * ID_BYTES
        if len(ends) != len(runs):
            raise ValueError("the tokenizer does not end each run with a word end")
        ends = ends.tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends, strict=False)]

    def _learn(self, words: list[str]) -> None:
        known = self.known
        # Most words are one run of letters, which one search finds in all of them; words hold no line feeds.
        letters = set(LETTERS.findall("\n".join(words)))
        rest = [w for w in words if w not in letters]
        cut = {w: RUNS.findall(w) for w in rest if PLAIN.fullmatch(w)}
        runs = list(letters.union(chain.from_iterable(cut.values())).difference(known))
        known.update(zip(runs, self._encode_runs(runs), strict=True))
        known.update((w, b"".join(map(known.__getitem__, parts))) for w, parts in cut.items())
        other = [w for w in rest if w not in cut]
        known.update(zip(other, self._encode(other), strict=True))

    def _words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return text.replace("\n", " ").split(" ")

    def of(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        words = [[] if i in whole else self._words(t) for i, t in enumerate(texts)]
        if len(self.known) > KNOWN_WORDS:
            self.known = {"": b""}
        unknown = list(set(chain.from_iterable(words)).difference(self.known))
        for at in range(0, len(unknown), 50_000):
            self._learn(unknown[at : at + 50_000])
        code = self.known.__getitem__
        coded = [b"".join(map(code, one)) for one in words]
        for i in whole:
            coded[i] = self._encode([texts[i]])[0]
        return coded


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker and tokenizer file."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def pack_cell(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Sequences as (tier, pieces). Only the last one may be shorter than its tier."""
    top = tiers[0]
    done: list[tuple[int, list[Piece]]] = []
    pools: dict[int, list[Piece]] = {t: [] for t in tiers}

    def route(piece: Piece) -> None:
        insort(pools[min(t for t in tiers if t >= piece[0])], piece)

    for doc, length in enumerate(lengths):
        whole, rest = divmod(length, top)
        done += [(top, [(top, doc, k * top)]) for k in range(whole)]
        if rest:
            pools[min(t for t in tiers if t >= rest)].append((rest, doc, whole * top))
    for pool in pools.values():
        pool.sort()

    def fit(gap: int, below: list[int]) -> Piece | None:
        for t in below:
            place = bisect_right(pools[t], (gap, len(lengths), 0))
            if place:
                return pools[t].pop(place - 1)
        for t in reversed(below):
            if pools[t]:
                length, doc, start = pools[t].pop(0)
                route((length - gap, doc, start + gap))
                return (gap, doc, start)
        return None

    for place, tier in enumerate(tiers):
        pool, below = pools[tier], list(tiers[place + 1 :]) or [tier]
        while pool:
            pieces, gap = [first := pool.pop()], tier - first[0]
            while gap and (piece := fit(gap, below) or fit(gap, [tier])):
                pieces.append(piece)
                gap -= piece[0]
            done.append((tier, pieces))
    return done


def step_groups(sequences: list[tuple[int, list[Piece]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Each sequence's group: dealt to and fro in order of attention cost, so groups cost the same."""
    groups = max(1, round(sum(t for t, _ in sequences) / step_tokens))
    cost = [sum(p[0] * p[0] for p in pieces) for _, pieces in sequences]
    dealt = [0] * len(sequences)
    for n, at in enumerate(sorted(range(len(cost)), key=lambda i: -cost[i])):
        turn, place = divmod(n, groups)
        dealt[at] = groups - 1 - place if turn % 2 else place
    return dealt


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece of a document in a sequence, columns as in ``PIECES``.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored. A document is its token ids and then
    the id 1, so a null or empty text is one token. ``offset`` is the piece's place in its sequence, ``tier``
    the sequence's length, which pieces fill exactly but for the last sequence of a cell (about
    ``CELL_TOKENS`` tokens of a partition). Sequence ids are unique, not consecutive. A null ``doc_id`` is
    kept; repeated rows are documents of their own. No rows give no rows.

    Each partition is packed by itself, in one pass and without a shuffle: whatever the number of rows,
    padding is one sequence per cell.
    """
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int32() if x.endswith(" int") else pa.int64() for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(tokenizer_path)
        end = array.array("I", [END_ID]).tobytes()
        base = TaskContext.get().partitionId() << PLACE_BITS
        sequence, group, held = base, base, 0
        ids: list[int | None] = []
        coded: list[bytes] = []

        def cell() -> pa.RecordBatch:
            nonlocal sequence, group
            lengths = [len(x) // ID_BYTES for x in coded]
            sequences = pack_cell(lengths, tiers)
            groups = step_groups(sequences)
            rows: list[list] = [[] for _ in names]
            for own, (tier, pieces) in zip(groups, sequences, strict=True):
                offset = 0
                for length, doc, start in pieces:
                    part = memoryview(coded[doc])[start * ID_BYTES : (start + length) * ID_BYTES]
                    row = (
                        ids[doc], start, length, zlib.crc32(part), lengths[doc], sequence, offset,
                        tier, group + own,
                    )
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            group += max(groups) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids += part.column("doc_id").to_pylist()
                coded += [x + end for x in coder.of(part.column("text").to_pylist())]
                held += sum(map(len, coded[len(coded) - part.num_rows :])) // ID_BYTES
                if held >= CELL_TOKENS:
                    yield cell()
                    ids, coded, held = [], [], 0
        if ids:
            yield cell()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
