import array
import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from edge_rows import EDGE_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreloom.llm import bpe
from scoreloom.llm.queries import op11_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CODER = bpe.byte_pairs(PATH, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})
TEXT = st.text(st.one_of(st.sampled_from(" \n\t'sreab.,!9²é́日\U0001f600<|>"), st.characters(codec="utf-8")), max_size=80)


def ids_of(*texts):
    return [array.array("I", data).tolist() for data in CODER.encode(list(texts))]


def plain_merge(ranks, data):
    """The definition: merge the leftmost of the lowest pairs until none has a rank."""
    if data in ranks:
        return [ranks[data]]
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_are_those_of_the_library(texts):
    assert ids_of(*texts) == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [CODER.decode(i).decode() for i in ids_of(*texts)] == texts


def test_every_code_point_is_cut_as_the_library_cuts_it():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}b {c}1{c} !{c}{c}x  {c}" for c in points[:: 7])
    assert ids_of(text) == [LIBRARY.encode_ordinary(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=5), st.permutations(range(6)))
def test_any_ranks_merge_by_the_definition(tmp_path_factory, texts, order):
    """Also where a merge makes a pair of a lower rank, which trained files seldom do."""
    tokens = [b"ab", b"ba", b"aab", b"aba", b"aa", b"abab"]
    lines = [(bytes([b]), b) for b in range(256)] + [(t, 256 + order[i]) for i, t in enumerate(tokens)]
    path = tmp_path_factory.mktemp("ranks") / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in lines))
    coder = bpe.BytePairs(str(path), r"\S+|\s+")
    data = [t.encode() for t in texts if t.encode() not in coder.ranks]
    expected = [plain_merge(coder.ranks, d) for d in data]
    assert [coder.merge_one(d) for d in data] == expected
    assert [array.array("I", ids).tolist() for ids in (coder.merge_many(data) if data else [])] == expected
    found = [array.array("I", ids).tolist() for ids in coder.encode(texts)]
    assert found == [plain_merge(coder.ranks, t.encode()) for t in texts]


@pytest.mark.parametrize("text", ["a" * 300_000, "xyz" * 100_000, "é日" * 50_000, "=" * 200_000, " " * 200_000])
def test_very_long_matches(text):
    assert ids_of(text, "between", text) == [LIBRARY.encode_ordinary(t) for t in (text, "between", text)]


def test_long_texts_are_cut_in_blocks_and_words_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 64)
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 2000)
    monkeypatch.setattr(bpe, "HELD", 100)
    text = " ".join(f"wort{n} it's  {n}!\n" for n in range(3000))
    assert ids_of(text, "", text[:50]) == [LIBRARY.encode_ordinary(t) for t in (text, "", text[:50])]


def test_queue_gives_the_lowest_rank_first():
    queue = bpe.RankQueue(70_000)
    for rank, at in ((69_999, 1), (64, 3), (64, 2), (4095, 9), (0, 5)):
        queue.push(rank, at)
    seen = []
    while (rank := queue.lowest()) is not None:
        seen.append((rank, sorted(queue.buckets[rank])))
        queue.buckets[rank].clear()
        queue.clear(rank)
    assert seen == [(0, [5]), (64, [2, 3]), (4095, [9]), (69_999, [1])]


def test_rows(spark, docs, empty):
    coded = bpe.encode(docs(EDGE_TEXTS), PATH, PATTERN)
    found = bpe.decode(coded, PATH, PATTERN).collect()
    expected = [(i, LIBRARY.encode_ordinary(t or "")) for i, t in EDGE_TEXTS]
    assert sorted([(r["doc_id"], r["ids"]) for r in found], key=repr) == sorted(expected, key=repr)
    assert sorted(bytes(r["bytes"]) for r in found) == sorted((t or "").encode() for _, t in EDGE_TEXTS)
    assert bpe.decode(bpe.encode(empty, PATH, PATTERN), PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([("x", None), ("y", [])], "doc_id string, ids array<int>")
    assert {r["doc_id"]: r["bytes"] for r in bpe.decode(odd, PATH, PATTERN).collect()} == {"x": None, "y": b""}
    with pytest.raises(ValueError):
        CODER.decode([50_256])


def test_the_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
