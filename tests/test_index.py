"""The index of landed files: the same documents from few files."""

from pathlib import Path

import pytest

from scoreloom.plans.daily import Tables, latest_documents, run_daily
from scoreloom.sources.landing import documents_from_strings, land_documents, read_documents
from scoreloom.streaming.index import PLACES_SCHEMA, LandingIndex
from scoreloom.streaming.runs import Runs


def doc(match_id, ts, *players, note=""):
    entries = ",".join(f'{{"puuid":"{p}"}}' for p in players)
    time = f'"gameEndTimestamp":{ts},' if ts is not None else ""
    return f'{{"metadata":{{"matchId":"{match_id}"}},"info":{{{time}"participants":[{entries}]}},"note":"{note}"}}'


@pytest.fixture
def index(tmp_path):
    return LandingIndex(str(tmp_path / "index"), str(tmp_path / "land ing"))


def land(spark, index, *payloads):
    land_documents(documents_from_strings(spark, list(payloads)).coalesce(1), index.landing, mode="append")


def rows(df):
    return sorted(r[0] for r in df.collect())


def test_only_files_that_the_index_names_are_opened(spark, index):
    for n in range(12):
        land(spark, index, doc(f"M{n}", n, "a" if n % 3 == 0 else "b"), doc(f"N{n}", n, "c"), "broken")
    index.update(spark)
    expected = rows(latest_documents(read_documents(spark, index.landing), "a", 2))
    wanted, files = index.latest(spark, "a", 2)
    assert [r.match_id for r in wanted.orderBy("rank").collect()] == ["M9", "M6"] and len(files) == 2
    for file in Path(index.landing).glob("part-*"):
        if not any(name.endswith(file.name) for name in files):
            file.write_bytes(b"changed after the landing")
    found = index.latest_documents(spark, "a", 2)
    assert rows(found) == expected and len(expected) == 2


def test_kept_up_with_each_landing(spark, index):
    land(spark, index, doc("M1", 1, "a"), doc("M2", 2, "a", "b"))
    index.update(spark)
    index.update(spark)
    assert index.places.read(spark).count() == 3
    land(spark, index, doc("M3", None, "a"), doc("M1", 5, "a", note="newer"), doc("M2", 2, "a", "b", note="copy"))
    index.update(spark)
    landed = read_documents(spark, index.landing)
    for player, n in (("a", 3), ("a", 2), ("a", 1), ("b", 20), ("nobody", 5)):
        assert rows(index.latest_documents(spark, player, n)) == rows(latest_documents(landed, player, n))
    new = index.places.read(spark).where("batch_id = 1")
    assert new.select("file").distinct().count() == 1 and new.count() == 4


def test_a_batch_that_is_run_again_names_nothing_twice(spark, index):
    land(spark, index, doc("M1", 1, "a"))
    named = read_documents(spark, index.landing).selectExpr("json_payload", "'f' AS file")
    for _ in range(2):
        index.take_batch(named, 0)
    assert index.places.read(spark).count() == 1


def test_the_daily_run_by_the_index(spark, index):
    for n in range(4):
        game = doc(f"M{n}", n, "a").replace('"puuid":"a"', '"puuid":"a","championName":"X","kills":1,"win":true')
        land(spark, index, game, doc(f"N{n}", n, "b"))
    plain = run_daily(spark, index.landing, "a", Tables("b_p", "s_p", "g_p"), latest=3)
    assert run_daily(spark, index.landing, "a", Tables("b_i", "s_i", "g_i"), latest=3, index=index) == plain
    assert rows(spark.table("b_i")) == rows(spark.table("b_p")) and plain["bronze"] == 3


def test_a_batch_is_stored_in_sorted_files_without_a_shuffle_by_ranges(spark, tmp_path):
    places = Runs(str(tmp_path / "places"), PLACES_SCHEMA, ("puuid", "match_id"), fan_in=2)
    rows = [(f"p{n % 7}", f"M{n}", n, "f") for n in range(700)]
    for batch in range(2):
        assert places.append(spark.createDataFrame(rows, PLACES_SCHEMA).repartition(3), batch).count() == 700

    def ranges(run):
        files = sorted((tmp_path / "places" / "rows" / f"run={run}").glob("part-*"))
        found = [[tuple(r) for r in spark.read.parquet(str(f)).select("puuid", "match_id").collect()] for f in files]
        assert all(one == sorted(one) for one in found) and sum(map(len, found)) in (700, 1400)
        return sorted((one[0][0], one[-1][0]) for one in found)

    assert ranges("0-0") == ranges("1-1") == [("p0", "p6")] * 3  # as they came
    apart = ranges("0-1")  # compacted: files hold ranges that lie apart
    assert all(a[1] <= b[0] for a, b in zip(apart, apart[1:], strict=False))
    assert places.read(spark).count() == 1400
