import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from edge_rows import EDGE_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scoreloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TEXT = st.text(st.one_of(st.sampled_from(" \n\t'sreA.,!_-9²é\u0301ÿΣİ<|>"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_by_word_are_the_ids_of_the_text(text):
    for t in (text, f"it's {text} <|endoftext|> we'll"):
        got = np.frombuffer(packing.word_ids(PATH).of([t])[0], "<u4").tolist()
        assert got == TOKENIZER.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60))
def test_cells_hold_each_id_once_and_pad_one_sequence(lengths):
    sequences = packing.pack_cell(lengths)
    short = [t for t, pieces in sequences if sum(p[0] for p in pieces) != t]
    assert len(short) <= 1
    parts = defaultdict(list)
    for _, pieces in sequences:
        for length, doc, start in pieces:
            assert length > 0
            parts[doc].append((start, length))
    for doc, total in enumerate(lengths):
        at = 0
        for start, length in sorted(parts[doc]):
            assert start == at
            at += length
        assert at == total


def test_step_groups_cost_the_same():
    sequences = packing.pack_cell([700 + 37 * i % 3000 for i in range(900)])
    cost = defaultdict(int)
    for own, (_, pieces) in zip(packing.step_groups(sequences), sequences, strict=True):
        cost[own] += sum(p[0] ** 2 for p in pieces)
    assert max(cost.values()) < 1.1 * min(cost.values())


def check(rows, texts):
    """Pieces of equal documents cannot be told apart, so they are checked per sequence and by count."""
    ids = {t: [*TOKENIZER.encode(t, add_special_tokens=False).ids, 1] for t in set(texts)}
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        own = [i for i in ids.values() if len(i) == r["doc_tokens"]]
        part = slice(r["start"], r["start"] + r["length"])
        assert r["ids_crc32"] in [zlib.crc32(np.array(i[part], "<u4").tobytes()) for i in own]
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= pieces[0]["tier"]
    assert sum(r["length"] for r in rows) == sum(len(ids[t]) for t in texts)


def test_edges(edge, empty):
    check(packing.pack(edge, PATH).collect(), [t or "" for _, t in EDGE_TEXTS])
    assert packing.pack(empty, PATH).collect() == []
