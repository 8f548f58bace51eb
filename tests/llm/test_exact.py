"""Operators and the pipeline against plain recomputation."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm import language, quality, sharding, simhash
from scoreloom.llm.queries import op3_quality, op4_language

SF = "/root/testdata/sf0.001"
WORDS = {
    "de": "der die das und nicht mit von haus baum wasser licht garten strasse kind".split(),
    "en": "the of and to in that house tree water light garden street child with".split(),
    "fr": "le la les et ne pas avec maison arbre eau lumiere jardin rue enfant".split(),
}


def plain_shards(rows, shards):
    """Shard and slot of each row, by exact fractions."""
    def tie(row):
        data = (row[1] or "").encode()
        return hashlib.md5(f"shard{row[0] if row[0] is not None else ''}".encode()).hexdigest(), row[0] or 0, len(data) + 8, zlib.crc32(data)

    by_source = defaultdict(list)
    for row in rows:
        by_source[(row[3] is None, row[3] or "")].append(row)
    ranked = []
    for source, own in by_source.items():
        for place, row in enumerate(sorted(own, key=tie)):
            ranked.append((float(Fraction(2 * place + 1, 2 * len(own))), source, tie(row), row))
    ranked.sort(key=lambda r: r[:3])
    placed, slots = [], Counter()
    for at, (_, _, _, row) in enumerate(ranked):
        number = at * shards // len(rows)
        placed.append((row[0], len((row[1] or "").encode()) + 8, number, slots[number]))
        slots[number] += 1
    return sorted(placed, key=repr)


@pytest.mark.parametrize("shards", [24, 5])
def test_shard_and_slot_of_each_row(docs, shards):
    rows = [(i, f"text {i} " * (i % 7), "en", ["a", "b", None, "é"][(i * i) % 11 % 4]) for i in range(211)]
    got = sharding.shard(docs(rows), shards).select("doc_id", "size", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=repr) == plain_shards(rows, shards)


def plain_score(net, data):
    """The network by loops over chunks, places, filters and bytes."""
    starts = range(0, max(1, -(-(len(data) - 64) // 192)) * 192, 192)
    best = []
    for start in starts:
        codes = [data[i] if i < len(data) else 256 for i in range(start, start + 256)]
        own = np.zeros(quality.FILTERS)
        for place in range(256 - 7):
            seen = net.embed[codes[place : place + 8]].astype(float).ravel()
            for f in range(quality.FILTERS):
                first = seen[:32] @ net.filters[:, f].astype(float)
                second = seen[32:] @ net.filters[:, quality.FILTERS + f].astype(float)
                own[f] = max(own[f], first + second + net.bias[f])
        best.append(own)
    features = np.concatenate([np.mean(best, axis=0), np.max(best, axis=0)])
    return 1 / (1 + np.exp(-(features @ net.weight.astype(float) + net.offset[0])))


def test_scores_equal_plain_loops():
    net = quality.Network.fresh(5)
    rng = np.random.default_rng(5)
    net.weight[:], net.bias[:] = rng.normal(0, 1, len(net.weight)), rng.normal(0, 0.1, len(net.bias))
    texts = ["", "short", "été " * 20, "x" * 256, "some longer text " * 40]
    found = quality.scores(net, texts)
    assert np.allclose(found, [plain_score(net, t.encode()) for t in texts], atol=1e-5)


def test_languages_equal_plain_sizes():
    raw = {lang: (" ".join(words) * 9).encode() for lang, words in WORDS.items()}
    own = language.Compressors(raw)
    for text in ("Das Haus und der Baum", "the light of the garden " * 200, "eau", "zzz qqq"):
        data = text.lower().encode()
        sizes = {}
        for lang, dictionary in raw.items():
            held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                language.LEVEL, source_size=language.PART, dict_size=len(dictionary),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            parts = [data[i : i + 1024] for i in range(0, len(data), 1024)]
            coded = [zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress(p) for p in parts]
            back = zstandard.ZstdDecompressor(dict_data=held)
            assert b"".join(back.decompress(c, max_output_size=2048) for c in coded) == data
            sizes[lang] = sum(map(len, coded))
        low, second = sorted(sizes.values())[:2]
        found = own.identify(text)
        assert found[0] == min(sizes, key=sizes.get) and found[2] == pytest.approx(second / low - 1)
        assert found[1] == pytest.approx(1 / sum(2.0 ** (-8 * (s - low)) for s in sizes.values()))


def test_three_hundred_languages(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}word " * 60, f"l{i:03d}") for i in range(300)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    raw = language.dictionaries(frame, most_chars=300 * 400)
    assert len(raw) == 300 and sum(map(len, raw.values())) <= 300 * 512
    assert list(language.dictionaries(frame, languages=7)) == [f"l{i:03d}" for i in range(7)]
    some = language.predict(frame.where("doc_id < 12").distinct(), raw).collect()
    assert all(r["lang_pred"] == r["lang"] for r in some)


def written(spark, docs, labels, path):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_held_out_labels_change_no_score(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    flipped = labels.withColumn("quality", F.when(crc % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    flipped.write.parquet(f"{tmp_path}/labels.parquet")
    other = docs.withColumn("lang", F.when(crc % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    other.write.parquet(f"{tmp_path}/documents.parquet")
    for query, column in ((op3_quality, "score"), (op4_language, "lang_pred")):
        before, after = ({r["doc_id"]: r[column] for r in query(spark, p).collect()} for p in (SF, str(tmp_path)))
        assert before == after


def test_stages_keep_columns_of_any_name(spark):
    names = ["_row", "row", "ROW_", "score", "known", "times", "_score", "_lang", "_times", "_time", "copies", "fp", "size"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns, name
        assert all(r[n] == f"{n} {r['doc_id']}" for r in left.collect() for n in names), name


def test_the_whole_pipeline_on_planted_documents(spark, tmp_path):
    rng = np.random.default_rng(8)

    def prose(lang, n):
        return " ".join(rng.choice(WORDS[lang], n))

    docs = [(i, prose(lang := list(WORDS)[i % 3], 60), lang, "ab"[i % 2], 0) for i in range(90)]
    docs += [(100 + i, "!!! $$$ ### buy @@@ 000 " * 12, "en", "a", 0) for i in range(30)]  # poor
    docs += [(200, "".join(chr(0x3B1 + k % 24) + " " * (k % 5 == 0) for k in range(300)), None, "b", 0)]  # no learned language
    docs += [(300 + i, docs[i][1], docs[i][2], "a", 0) for i in range(10)]  # copies
    docs += [(400, None, None, None, None), (401, "", "en", "a", 0)]
    labels = [(i, int(i < 100), 0) for i, *_ in docs if i < 130]
    path = written(spark, docs, labels, tmp_path)

    every = {i: (t or "").encode() for i, t, *_ in docs}
    spread = lambda c: c[np.linspace(0, len(c) - 1, min(quality.SAMPLE_CHUNKS, len(c))).astype(int)]
    net = quality.train([(spread(quality.chunks(every[i])), k) for i, k, _ in sorted(labels)])
    good = [d for d in docs if quality.scores(net, [d[1]])[0] >= 0.3]
    assert {d[0] for d in good if d[0] < 130} == set(range(90))

    pieces = defaultdict(list)
    for i, text, lang, *_ in good:
        if lang is not None and text is not None:
            pick = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
            pick -= (pick >= 1 << 63) << 64
            at = pick % (max(len(text) - language.SAMPLE_CHARS, 0) + 1)
            pieces[lang].append((pick, text[at : at + language.SAMPLE_CHARS].lower()))
    common = sorted(pieces, key=lambda lang: (-len(pieces[lang]), lang))
    own = language.Compressors({lang: "\n".join(p for _, p in sorted(pieces[lang])).encode() for lang in common})
    known = []
    for d in good:
        lang, _, margin = own.identify(d[1])
        narrow = margin < corpus_pipeline.MIN_MARGIN and (len((d[1] or "").encode()) >= language.MARGIN_BYTES or margin == 0)
        if lang != language.UNKNOWN and not narrow:
            known.append(d)
    assert {d[0] for d in known} >= set(range(90)) and not {200, 400, 401} & {d[0] for d in known}

    prints = {d[0]: simhash.simhash(d[1]) for d in known}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = [d for d in known if find(d[0]) == d[0]]
    assert not any(300 <= d[0] < 400 for d in kept)

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {d[0]: [*coder.encode(d[1], add_special_tokens=False).ids, 1] for d in kept}
    size = {d[0]: len(d[1].split()) for d in kept}
    total = sum(size.values())
    of_source = Counter()
    for d in kept:
        of_source[d[3]] += size[d[0]]
    target = {"a": min(3 * of_source["a"], total * 5 / 7), "b": min(3 * of_source["b"], total * 2 / 7)}

    found = corpus_pipeline.run(spark, path).collect()
    ids_in = Counter()
    for r in found:
        ids_in[r["doc_id"]] += r["length"]
        part = tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    taken = Counter()
    for i, n in ids_in.items():
        assert n % len(tokens[i]) == 0 and 1 <= n // len(tokens[i]) <= 3
        taken[next(d[3] for d in kept if d[0] == i)] += n // len(tokens[i]) * size[i]
    for source, want in target.items():
        assert abs(taken[source] - want) <= max(size.values())
