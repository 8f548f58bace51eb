import math
from collections import defaultdict

import pytest
from edge_rows import EDGE_TEXTS

from pyspark.sql import functions as F
from scoreloom.llm import ctw


def brute(train, texts):
    """Context-tree weighting node by node, as it is defined."""
    depth = ctw.DEPTH
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(text):
        data = bytes([255]) * depth + b" ".join(text.encode().lower().split()) + b"\xff"
        for at in range(depth, len(data)):
            context = data[at - depth : at][::-1]
            for bit in range(8):
                yield context, (1 << bit) | (data[at] >> (8 - bit)), (data[at] >> (7 - bit)) & 1

    for text in train:
        for context, place, bit in steps(text):
            for d in range(depth + 1):
                counts[context[:d], place][bit] += 1
                if d:
                    children[context[: d - 1], place].add(context[:d])

    def estimate(node):
        zeros, ones = counts.get(node, (0, 0))
        g = math.lgamma
        return g(zeros + 0.5) + g(ones + 0.5) - g(zeros + ones + 1) - math.log(math.pi)

    memo = {}

    def weighted(context, place):
        node = (context, place)
        if node not in memo:
            if len(context) == depth:
                memo[node] = estimate(node)
            else:
                deeper = sum(weighted(c, place) for c in children.get(node, ()))
                a, b = math.log(0.5) + estimate(node), math.log(0.5) + deeper
                memo[node] = max(a, b) + math.log1p(math.exp(-abs(a - b)))
        return memo[node]

    def probability(context, place, bit, d):
        node = (context[:d], place)
        zeros, ones = counts.get(node, (0, 0))
        own = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        if d == depth:
            return own
        stop = math.exp(math.log(0.5) + estimate(node) - weighted(*node))
        return stop * own + (1 - stop) * probability(context, place, bit, d + 1)

    return [sum(math.log10(probability(c, p, b, 0)) for c, p, b in steps(t)) for t in texts]


def test_matches_the_definition(spark, docs):
    rows = [
        (1, "The cat sat on the mat and the cat ate"),
        (2, "the dog sat on the log"),
        (3, "a cat and a dog on a mat"),
        (4, "Été à la mer et la mer"),
        (5, "quite another zebra"),
    ]
    learnt = [1, 2, 4]
    got = {r["doc_id"]: r for r in ctw.score(docs(rows), F.col("doc_id").isin(learnt)).collect()}
    want = brute([t for i, t in rows if i in learnt], [t for _, t in rows])
    for (key, text), score in zip(rows, want, strict=True):
        assert got[key]["score"] == pytest.approx(score, rel=1e-6)
        assert got[key]["n_tokens"] == len(text.split()) + 1
    words = [w for i, t in rows if i in learnt for w in [*t.lower().split(), None]]
    total, distinct = len(words), len(set(words))
    for key, text in rows:
        tokens = [*text.lower().split(), None]
        base = sum(math.log10((words.count(w) + 1) / (total + distinct + 1)) for w in tokens)
        assert got[key]["base_score"] == pytest.approx(base)
        assert got[key]["n_known"] == sum(w in words for w in tokens)
        assert got[key]["train_tokens"] == total


def test_edges(edge, empty):
    rows = ctw.score(edge, F.col("doc_id") != 5).collect()
    assert len(rows) == len(EDGE_TEXTS)
    ends = [r for r in rows if r["n_tokens"] == 1]
    assert len(ends) == 4 and len({r["score"] for r in ends}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1
    assert ctw.score(empty, F.lit(True)).collect() == []


def test_without_training_every_bit_costs_one(docs):
    row = ctw.score(docs([(1, "ab c")]), F.lit(None).cast("boolean")).first()
    assert row["score"] == pytest.approx(-8 * 5 * math.log10(2))
    assert row["bits_per_byte"] == pytest.approx(8)
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0)
