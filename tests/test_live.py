"""The stream: equal to the batch result, counted once, and safe to run again."""

import pytest

from scoreloom.operators.games import every_player_games
from scoreloom.operators.stats import champion_stats
from scoreloom.sources.landing import documents_from_strings, land_documents, read_documents
from scoreloom.streaming.live import LiveStats
from scoreloom.streaming.runs import Run, Runs, compacted
from scoreloom.workload import matches as m


def entry(player, champion, kills, win):
    return (
        f'{{"puuid":"{player}","championName":"{champion}","kills":{kills},"deaths":1,'
        f'"assists":2,"win":{str(win).lower()}}}'
    )


def doc(match_id, *entries):
    metadata = f'"metadata":{{"matchId":"{match_id}"}},' if match_id else ""
    return f'{{{metadata}"info":{{"participants":[{",".join(entries)}]}}}}'


M1 = doc("M1", entry("a", "X", 3, True), entry("b", "Y", 4, False))
M2 = doc("M2", entry("a", "X", 6, False), entry("a", "Z", 9, True))
M3 = doc("M3", entry("b", "Y", 5, True))
NO_ID = doc("", entry("a", "X", 1, True))


def land(spark, path, *payloads):
    land_documents(documents_from_strings(spark, list(payloads)).coalesce(1), path, mode="append")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def setup(tmp_path):
    return LiveStats(str(tmp_path / "live")), str(tmp_path / "landing")


def run(spark, live, landing, files=1):
    live.start(spark, landing, files_per_batch=files, once=True).awaitTermination()
    return rows(live.stats(spark))


def test_several_batches_equal_one_batch_run(spark, setup):
    live, landing = setup
    for payload in (M1, M2, M3, "not json", NO_ID):
        land(spark, landing, payload)
    found = run(spark, live, landing)
    landed = read_documents(spark, landing)
    assert found == rows(champion_stats(every_player_games(landed)))


def test_first_batch_without_games(spark, setup):
    live, landing = setup
    land(spark, landing, "not json")
    assert run(spark, live, landing) == []
    land(spark, landing, M1)
    assert [r[0] for r in run(spark, live, landing)] == ["X", "Y"]


def test_documents_landed_again_are_not_counted_again(spark, setup):
    live, landing = setup
    land(spark, landing, M1, M2, M1)
    first = run(spark, live, landing)
    land(spark, landing, M2, M1)
    assert run(spark, live, landing) == first
    land(spark, landing, M1, M3)
    expected = champion_stats(every_player_games(documents_from_strings(spark, [M1, M2, M3])))
    assert run(spark, live, landing) == rows(expected)


def test_documents_without_an_id_all_count(spark, setup):
    live, landing = setup
    land(spark, landing, NO_ID, NO_ID)
    land(spark, landing, NO_ID)
    assert [r[1] for r in run(spark, live, landing)] == [3]


def test_a_repeated_batch_changes_nothing(spark, setup):
    """After a failure Spark hands out the same batch under the same id."""
    live, _ = setup
    first, second = (documents_from_strings(spark, p) for p in ([M1], [M2, M1, M3]))
    live.take_batch(first, 0)
    live.take_batch(second, 1)
    once = rows(live.stats(spark))
    live.take_batch(second, 1)
    assert rows(live.stats(spark)) == once
    assert live.games(spark).count() == 4


def test_stream_over_the_tables_equals_batch(spark, sf_dir, setup):
    live, landing = setup
    documents = m.documents(spark, sf_dir)
    land_documents(documents.repartition(6), landing)
    found = run(spark, live, landing, files=2)
    assert found == rows(champion_stats(every_player_games(documents)))


def test_of_differing_copies_the_same_one_always_counts(spark, setup):
    live, _ = setup
    copies = [M1, M1.replace('"kills":3', '"kills":30')]
    for order in (copies, copies[::-1]):
        live.take_batch(documents_from_strings(spark, order), 0)
        assert [r.media_kills for r in live.stats(spark).collect() if r.champion == "X"] == [3.0]


def test_history_is_read_by_the_ranges_of_each_prefix(spark, setup, plan_of):
    live, _ = setup
    old = [doc(f"{p}_{n}", entry("a", "X", 1, True)) for p in ("EU", "NA") for n in range(1000, 1400)]
    live.take_batch(documents_from_strings(spark, old), 0)
    new = [doc(i, entry("a", "X", 1, True)) for i in ("EU_1399", "EU_1400", "NA_1399", "NA_1400")]
    live.take_batch(documents_from_strings(spark, new), 1)
    assert live.stats(spark).first().total_partidas == 802
    arrived = live.games(spark).where("batch_id = 1")
    assert arrived.count() == 2
    history = live._seen_before(documents_frame(spark, ["EU_1399", "NA_1399"]), 1)
    plan = plan_of(history)
    assert "EU_1399" in plan and "NA_1399" in plan and "GreaterThanOrEqual(match_id" in plan


def documents_frame(spark, ids):
    return spark.createDataFrame([(i, "a") for i in ids], "match_id string, puuid string")


def test_old_sums_are_removed(spark, setup, tmp_path):
    live, landing = setup
    for n in range(6):
        land(spark, landing, doc(f"M{n}", entry("a", "X", 1, True)))
        run(spark, live, landing)
    kept = sorted(p.name for p in (tmp_path / "live" / "sums").iterdir())
    assert kept == ["batch_id=3", "batch_id=4", "batch_id=5"]
    assert run(spark, live, landing)[0][1] == 6


def test_runs_grow_with_the_logarithm_of_the_batches():
    runs, most, rewritten = [], 0, 0
    for n in range(4096):
        before, runs = runs, compacted([*runs, Run(n, n, 10)], fan_in=4)
        assert runs[0].first == 0 and runs[-1].last == n
        assert all(a.last + 1 == b.first for a, b in zip(runs, runs[1:], strict=False))
        assert sum(r.rows for r in runs) == 10 * (n + 1)
        rewritten += 0 if runs[-1].first == n else runs[-1].rows
        most = max(most, len(runs))
        if n + 1 in (64, 4096):
            assert len(runs) == 1 and most <= 3 * (n + 1).bit_length() / 2 + 1
    assert rewritten <= 10 * 4096 * 6  # each game is written again at most once a size


def test_runs_of_the_largest_size_are_left_alone():
    runs = []
    for n in range(64):
        runs = compacted([*runs, Run(n, n, 10)], fan_in=2, most_rows=80)
    assert runs == [Run(n, n + 7, 80) for n in range(0, 64, 8)]


def test_batches_are_compacted_and_counted_once(spark, tmp_path):
    live = LiveStats(str(tmp_path / "live"), fan_in=2)
    landed = []
    for n in range(9):
        new = [doc(f"M{n}", entry("a", "X", n, True)), doc(f"M{max(0, n - 3)}", entry("a", "X", 1, True))]
        landed += new
        live.take_batch(documents_from_strings(spark, new), n)
        assert live.games(spark).count() == n + 1
        assert len(live.runs.after(spark)) == bin(n + 1).count("1")
    folders = sorted(p.name for p in (tmp_path / "live" / "games" / "rows").iterdir())
    assert {"run=0-7", "run=8-8"} <= set(folders) and len(folders) <= 6
    opened = {name.split("run=")[1].split("/")[0] for name in live.games(spark).inputFiles()}
    assert opened == {"0-7", "8-8"}
    once = {(f"M{n}", n) for n in range(9)}
    assert {(r.match_id, r.batch_id) for r in live.games(spark).collect()} == once
    assert rows(live.stats(spark))[0][1] == 9


def test_a_failure_during_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    live = LiveStats(str(tmp_path / "live"), fan_in=2)
    batches = [documents_from_strings(spark, [doc(f"M{n}", entry("a", "X", n, True))]) for n in range(4)]
    for n in range(3):
        live.take_batch(batches[n], n)
    before = rows(live.stats(spark))
    plain = Runs.write

    def breaks(self, rows, run):
        plain(self, rows, run)
        if run.batches > 1:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Runs, "write", breaks)
        with pytest.raises(RuntimeError):
            live.take_batch(batches[3], 3)
    assert rows(live.stats(spark)) == before and live.games(spark).count() == 3
    for _ in range(2):  # the second one is a replay of a batch that was compacted
        live.take_batch(batches[3], 3)
        assert live.runs.after(spark) == [Run(0, 3, 4)]
        assert live.games(spark).count() == 4 and rows(live.stats(spark))[0][1] == 4


def test_nothing_counted_yet(spark, tmp_path):
    live = LiveStats(str(tmp_path / "live"))
    assert live.stats(spark).count() == 0 and live.games(spark).count() == 0 and compacted([]) == []


def test_only_games_that_may_come_again_are_compared(spark, tmp_path, monkeypatch):
    """Games that come once are neither shuffled nor looked up by their ids."""
    live, plain, compared = LiveStats(str(tmp_path / "live")), LiveStats._seen_before, []

    def counts(self, arrived, batch_id):
        compared.append(sorted(r.match_id for r in arrived.collect()))
        return plain(self, arrived, batch_id)

    monkeypatch.setattr(LiveStats, "_seen_before", counts)
    old = [doc(f"M{n}", entry("a", "X", 1, True)) for n in range(100, 150)]
    live.take_batch(documents_from_strings(spark, old), 0)
    new = [doc(f"M{n}", entry("a", "X", 1, True)) for n in range(120, 121)]  # counted before
    new += [doc("M200", entry("a", "X", k, True)) for k in (7, 5, 5, 9)]  # copies that differ
    new += [doc(f"M{n}", entry("a", "X", 1, True)) for n in range(110, 111)]
    new += [doc(f"M1{n}5", entry("b", "X", 1, True)) for n in range(5)]  # another player's, in old matches or not
    for _ in range(2):  # the second time after a failure
        live.take_batch(documents_from_strings(spark, [*new, NO_ID, NO_ID]), 1)
        assert compared[-1] == ["M110", "M120", *["M200"] * 4]
        brought = live.games(spark).where("batch_id = 1")
        found = sorted((r.match_id, r.puuid, r.kills) for r in brought.collect())
        assert found == [("", "a", 1), ("", "a", 1), *[(f"M1{n}5", "b", 1) for n in range(5)], ("M200", "a", 5)]
        assert live.stats(spark).first().total_partidas == 58
