"""The stream of latest matches: equal to the batch result whatever comes late or twice."""

import random

import pytest

from scoreloom.operators.documents import latest_matches, match_index
from scoreloom.sources.landing import documents_from_strings, land_documents, read_documents
from scoreloom.streaming.latest import LatestMatches


def doc(match_id, ts, *players):
    entries = ",".join(f'{{"puuid":"{p}"}}' for p in players)
    time = f'"gameEndTimestamp":{ts},' if ts is not None else ""
    return f'{{"metadata":{{"matchId":"{match_id}"}},"info":{{{time}"participants":[{entries}]}}}}'


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def stream(tmp_path):
    return LatestMatches(str(tmp_path / "stream"), n=3, buckets=4)


def test_late_and_repeated_matches(spark, stream):
    draw = random.Random(3)
    documents = [doc(f"M{i}", draw.choice([None, i, i // 3, 50 - i]), "a", f"p{i % 5}") for i in range(40)]
    documents += [doc(f"M{i}", 60 + i, "a") for i in range(0, 40, 9)] + documents[:10] + ["broken", "{}"]
    draw.shuffle(documents)
    taken = []
    for batch, start in enumerate(range(0, len(documents), 14)):
        part = documents_from_strings(spark, documents[start : start + 14])
        taken += documents[start : start + 14]
        stream.take_batch(part, batch)
        expected = rows(latest_matches(match_index(documents_from_strings(spark, taken)), 3))
        assert rows(stream.latest(spark)) == expected
        assert stream.state.read(spark).groupBy("puuid").count().where("count > 3").isEmpty()
        if batch == 1:
            stream.take_batch(part, batch)  # run again after a failure
            assert rows(stream.latest(spark)) == expected


def test_only_buckets_of_the_batch_are_written(spark, stream):
    stream.take_batch(documents_from_strings(spark, [doc(f"M{i}", i, f"p{i}") for i in range(30)]), 0)
    before = stream.state.places(spark)
    stream.take_batch(documents_from_strings(spark, [doc("N", 99, "p1")]), 1)
    after = stream.state.places(spark)
    assert len(before) == 4 and sum(before[b] != after[b] for b in before) == 1
    stream.take_batch(documents_from_strings(spark, ["broken"]), 2)
    assert stream.state.places(spark) == after


def test_files_as_they_land(spark, stream, tmp_path):
    landing = str(tmp_path / "landing")
    for third in range(3):
        new = documents_from_strings(spark, [doc(f"M{i}", i, "a", f"p{i % 4}") for i in range(third, 30, 3)])
        land_documents(new.coalesce(1), landing, mode="append")
        stream.start(spark, landing, files_per_batch=1, once=True).awaitTermination()
    assert rows(stream.latest(spark)) == rows(latest_matches(match_index(read_documents(spark, landing)), 3))
    assert len([r for r in stream.latest(spark).collect() if r.puuid == "a"]) == 3
