from collections import Counter, defaultdict

import pytest
import zlib
from edge_rows import EDGE_TEXTS

from scoreloom.llm import mixing, sharding

SOURCES = [("a", 40, 30), ("b", 3, 5), ("c", 200, 2), (None, 9, 50), ("é", 1, 0), ("z", 25, 11)]


def rows():
    out = []
    for source, count, words in SOURCES:
        out += [(len(out) + i, " ".join(["w"] * (words + i % 3 if words else 0)), "en", source) for i in range(count)]
    return out


def filled(sizes, weights, epochs, total):
    """Clamp and share again, one source at a time."""
    target, open_, left = {}, set(sizes), total
    while True:
        share = {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] >= epochs * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = epochs * sizes[s]
            open_.discard(s)
            left -= target[s]


def test_mix(docs):
    data = rows()
    got = mixing.mix(docs(data)).collect()
    sizes, longest = Counter(), Counter()
    for _, text, _, source in data:
        sizes[source] += len(text.split())
        longest[source] = max(longest[source], len(text.split()))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = filled(sizes, weights, 3, sum(sizes.values()))
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1e-6
    assert len(got) == len(data)
    again = mixing.mix(docs(data[::-1])).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_edges(docs, edge, empty):
    got = mixing.mix(edge).collect()
    assert len(got) == len(EDGE_TEXTS) and all(r["size"] == len((t["text"] or "").split()) for r, t in zip(sorted(got, key=lambda r: r["size"]), sorted(edge.collect(), key=lambda t: len((t["text"] or "").split())), strict=True) if r["size"] < 5)
    assert mixing.mix(empty).collect() == []
    nothing = mixing.mix(docs([(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert {(r["target"], r["taken"]) for r in nothing} == {(0.0, 0)}


@pytest.mark.parametrize("shards", [24, 7, 1])
def test_shards_match_the_mixture(docs, shards):
    data = rows()
    got = sharding.shard(docs(data), shards).collect()
    per = Counter(r["shard"] for r in got)
    assert set(per) == set(range(shards)) and max(per.values()) - min(per.values()) <= 1
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        mixture[r["source"]][r["shard"]] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for source, counts in mixture.items():
        share = sum(counts.values()) / len(data)
        assert all(abs(counts[k] - share * per[k]) <= 2 for k in range(shards)), source


def test_shard_edges(edge, empty):
    got = sharding.shard(edge, 24).collect()
    texts = sorted((t or "").encode() for _, t in EDGE_TEXTS)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len(t) + 8, zlib.crc32(t)) for t in texts)
    assert max(Counter(r["shard"] for r in got).values()) == 1 and {r["slot"] for r in got} == {0}
    assert sharding.shard(empty).collect() == []
