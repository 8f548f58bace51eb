import corpus_pipeline
import numpy as np
from edge_rows import EDGE_TEXTS

from scoreloom.llm import language, quality
from scoreloom.llm.queries import op3_quality, op4_language

SF = "/root/testdata/sf0.01"


def test_chunks_cover_the_text():
    for size in (0, 1, 255, 256, 257, 448, 449, 5000):
        data = bytes(i % 251 for i in range(size))
        parts = quality.chunks(data)
        step = quality.STEP
        whole = np.full((len(parts) - 1) * step + quality.CHUNK, 256)
        for k, part in enumerate(parts):
            whole[k * step : k * step + quality.CHUNK] = part
        assert bytes(whole[:size].astype(np.uint8)) == data and (whole[size:] == 256).all()
        assert len(whole) - size < quality.CHUNK or size == 0


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(1)
    net = quality.Network.fresh(3)
    net.weight[:] = rng.normal(0, 1, len(net.weight))
    for part in net.parts:
        setattr(net, part, getattr(net, part).astype(np.float64))
    codes = rng.integers(0, 257, (5, quality.CHUNK)).astype(np.uint16)
    counts, labels = np.array([2, 3]), np.array([1, 0])

    def loss():
        pooled = quality.responses(net, codes)[2]
        p = quality.sigmoid(quality.combine(pooled, np.array([0, 2]), counts) @ net.weight + net.offset)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    found = quality._gradients(net, codes, counts, labels)
    for part, gradient in zip(net.parts, found, strict=True):
        value = getattr(net, part)
        for at in rng.integers(0, value.size, 12):
            place = np.unravel_index(at, value.shape)
            kept, step = value[place], 1e-5
            value[place] = kept + step
            up = loss()
            value[place] = kept - step
            down = loss()
            value[place] = kept
            assert abs((up - down) / (2 * step) - gradient[place]) < 1e-5


def test_a_long_text_is_scored_as_a_whole():
    net = quality.Network.fresh()
    net.weight[:] = 1
    text = "abc def " * 400_000
    apart = quality.responses(net, quality.chunks(text.encode()))[2]
    want = quality.combine(apart, np.array([0]), np.array([len(apart)])) @ net.weight
    assert np.allclose(quality.scores(net, ["x", text, None])[1], quality.sigmoid(want))


def test_quality_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op3_quality(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.93


def test_quality_edges(docs, edge, empty):
    net = quality.train([])
    rows = quality.classify(edge, net).collect()
    assert len(rows) == len(EDGE_TEXTS) and {r["score"] for r in rows} == {0.5}
    assert quality.classify(empty, net).collect() == []
    assert quality.sample(empty, empty.selectExpr("doc_id", "1 AS label")) == []


def test_language_held_out(spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in op4_language(spark, SF).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in rows]) > 0.98


def test_language_edges(docs, edge, empty):
    learnt = docs([(i, f"der die das und nicht {i}" * 20, "de", "s") for i in range(20)] + [(99, "the of and to in " * 50, "en", "s"), (98, None, "fr", "s"), (97, "x", None, "s")])
    raw = language.dictionaries(learnt)
    assert list(raw) == ["de", "en"]
    rows = language.predict(edge, raw).collect()
    assert len(rows) == len(EDGE_TEXTS)
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or ""))) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    sure = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs([(1, "und nicht das der die " * 9), (2, "in and of the to " * 9), (3, "qqq www eee " * 9)]), raw, 0.05).collect()}
    assert (sure[1], sure[2]) == ("de", "en")
    assert language.predict(empty, raw).collect() == []
    assert {r["lang_pred"] for r in language.predict(edge, language.dictionaries(empty)).collect()} == {"und"}


def test_noise_has_no_language(spark):
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, rng.integers(2, 10)))) for _ in range(n))
    noise = [(10**9 + i, words(n), None) for i, n in enumerate([3, 5, 8, 20, 40, 100, 400] * 30)]
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").join(clean, "doc_id", "left_semi")
    docs = real.union(spark.createDataFrame(noise, real.schema))
    kept = [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, SF).select("doc_id").collect()]
    assert sum(k >= 10**9 for k in kept) < 0.05 * len(noise)
    assert sum(k < 10**9 for k in kept) > 0.97 * real.count()


def test_a_repeated_id_is_learnt_once(docs):
    repeated = docs([(1, f"good text {i}") for i in range(50)] + [(2, "bad"), (3, "fine")])
    known = docs([(1, None)] * 30 + [(2, None), (3, None)]).selectExpr("doc_id", "int(doc_id <> 2) AS label")
    found = quality.sample(repeated, known, rows=2)
    want = [(min(quality.chunks(f"good text {i}".encode()).tobytes() for i in range(50)), 1)]
    want += [(quality.chunks(t).tobytes(), k) for t, k in ((b"bad", 0), (b"fine", 1))]
    assert [(c.tobytes(), k) for c, k in found] == want


def test_filters_see_every_alignment():
    net = quality.Network.fresh(3)
    pooled = [quality.responses(net, quality.chunks(b"." * k + b"pattern!" + b"." * (240 - k)))[2] for k in range(20, 28)]
    for other in pooled[1:]:
        assert np.allclose(other, pooled[0], atol=1e-5)
