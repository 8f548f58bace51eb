import hashlib

import numpy as np
import pytest
from edge_rows import EDGE_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreloom.llm import prefixes

SHORT = st.text(st.sampled_from("ab\U0001f600"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(SHORT, SHORT)
def test_spans_and_extensions(a, b):
    x, y = prefixes.Prefixes(prefixes.codes_of(a)), prefixes.Prefixes(prefixes.codes_of(b))
    for i in range(len(a)):
        for j in range(len(b)):
            most = min(len(a) - i, len(b) - j)
            want = next((k for k in range(most) if a[i + k] != b[j + k]), most)
            assert prefixes.common_extension(x, y, i, j, most) == want
            assert (x.span(i, i + most) == y.span(j, j + most)) == (a[i : i + most] == b[j : j + most])


def test_reduction_is_the_remainder():
    x = np.random.default_rng(1).integers(0, 1 << 62, 10_000, dtype=np.uint64)
    edge = np.array([0, prefixes.PRIME, prefixes.PRIME + 1, 2 * prefixes.PRIME, (1 << 62) - 1], np.uint64)
    for part in (x, edge):
        assert (prefixes._reduce(part) == part % np.uint64(prefixes.PRIME)).all()


@pytest.mark.parametrize("size", [prefixes.BLOCK - 1, prefixes.BLOCK, prefixes.BLOCK + 5, 2 * prefixes.BLOCK + 100])
def test_blocks_do_not_show(size, monkeypatch):
    codes = np.random.default_rng(size).integers(97, 1 << 15, size)
    text = "".join(map(chr, codes))
    whole = prefixes.fingerprint(text)
    for block in (prefixes.BLOCK, 5_000):
        monkeypatch.setattr(prefixes, "BLOCK", block)
        assert prefixes.fingerprint(text) == whole
        own = prefixes.Marked(text)
        other = prefixes.Marked(text[: size - 3] + "a" + text[size - 2 :])
        assert prefixes.common_prefix(own, other) == size - 3
        assert prefixes.common_prefix(own, prefixes.Marked(text[: size // 2])) == size // 2
        assert prefixes.common_prefix(own, prefixes.Marked(text)) == size
        assert prefixes.common_prefix(own, prefixes.Marked("")) == 0


def brute(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (key, text), (_, following) in zip(rows, [*rows[1:], *rows[:1]], strict=True):
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        prints = [prefixes.fingerprint(t) for t in (text, changed, following)]
        shared = next((i for i, (x, y) in enumerate(zip(text, changed, strict=False)) if x != y), min(len(text), len(changed)))
        out.append((
            key, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
            prefixes.likeness(*prints[:2]), prefixes.likeness(prints[0], prints[2]), shared,
        ))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in prefixes.fingerprints(frame).collect()), key=repr)


def test_edges(docs, edge, empty):
    assert rows_of(edge) == brute(EDGE_TEXTS)
    assert rows_of(empty) == []
    one = rows_of(docs([(9, "abcdefgh")]))
    assert one == brute([(9, "abcdefgh")]) and one[0][6] == 1.0
    many = [(i * 3 % 101, f"text {i} " * (i % 7)) for i in range(101)]
    assert rows_of(docs(many)) == brute(many)


def test_likeness_follows_the_shared_part():
    rng = np.random.default_rng(2)
    text, other = ("".join(map(chr, rng.integers(97, 123, 20_000))) for _ in range(2))
    own = prefixes.fingerprint(text)
    near = [
        prefixes.likeness(own, prefixes.fingerprint(text[: 20_000 - cut] + other[:cut]))
        for cut in (0, 1_000, 5_000, 20_000)
    ]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[3] < 0.1


@pytest.mark.parametrize("size", [1_000_000, 5_000_000])
def test_long_unrelated_texts_are_unlike(size):
    rng = np.random.default_rng(size)
    text, other = ("".join(map(chr, rng.integers(97, 123, size))) for _ in range(2))
    own = prefixes.fingerprint(text)
    assert prefixes.likeness(own, prefixes.fingerprint(other)) < 0.05
    half = prefixes.likeness(own, prefixes.fingerprint(text[: size // 2] + other[size // 2 :]))
    assert 0.1 < half < 0.6  # a third of the spans of both are shared
