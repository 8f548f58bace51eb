"""The daily run and its tables."""

from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.errors import PySparkException

from scoreloom.operators.documents import latest_matches, match_index
from scoreloom.operators.games import player_games
from scoreloom.operators.stats import champion_stats
from scoreloom.plans.daily import Tables, run_daily
from scoreloom.sources.landing import land_documents
from scoreloom.sources.shared import own_run, publish, remove_run, run_folder, shared_folder
from scoreloom.sources.tables import (
    default_location,
    overwrite_table,
    remove_old_versions,
    scan_table,
    table_location,
)
from scoreloom.workload import matches as m


@pytest.fixture
def names():
    suffix = uuid4().hex
    return Tables(f"b_{suffix}", f"s_{suffix}", f"g_{suffix}")


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "docs")
    land_documents(m.documents(spark, sf_dir), path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_first_and_second_run(spark, sf_dir, landing, names):
    counts = run_daily(spark, landing, "P7", names, latest=None)
    games = player_games(m.documents(spark, sf_dir), "P7")
    assert counts == {"bronze": 6000, "silver": games.count(), "gold": champion_stats(games).count()}
    first = rows(spark.table(names.stats))
    assert first == rows(champion_stats(games))
    assert run_daily(spark, landing, "P7", names, latest=None) == counts
    assert rows(spark.table(names.stats)) == first
    assert not spark.catalog.tableExists(names.raw)  # all of landing is read where it lies


def test_latest_matches_only(spark, sf_dir, landing, names):
    counts = run_daily(spark, landing, "P7", names)
    assert (counts["bronze"], counts["silver"]) == (20, 20)
    newest = latest_matches(match_index(m.documents(spark, sf_dir)).where("puuid = 'P7'"), 20)
    ids = {r.match_id for r in newest.collect()}
    assert {r.match_id for r in spark.table(names.games).collect()} == ids


def test_another_player_keeps_earlier_champions(spark, landing, names):
    run_daily(spark, landing, "P7", names)
    before = {r[0] for r in spark.table(names.stats).select("champion").collect()}
    run_daily(spark, landing, "P3", names)
    after = rows(spark.table(names.stats))
    assert before <= {r[0] for r in after}
    assert len(after) == len({r[0] for r in after})


def test_a_failing_step_stops_the_run(spark, names):
    with pytest.raises(PySparkException):
        run_daily(spark, "/nonexistent/landing", "P7", names)
    assert not spark.catalog.tableExists(names.stats)


def test_overwrite_replaces_and_may_read_itself(spark):
    table = f"t_{uuid4().hex}"
    assert overwrite_table(spark.range(5), table) == 5
    assert overwrite_table(spark.table(table).where("id < 2"), table) == 2
    assert rows(scan_table(spark, table)) == [(0,), (1,)]
    assert overwrite_table(spark.range(3).selectExpr("cast(id as string) AS name"), table) == 3
    assert scan_table(spark, table).columns == ["name"]


def test_tables_stay_in_their_own_storage(spark):
    """Every overwrite is a new version beside the ones before."""
    table = f"t_{uuid4().hex}"
    overwrite_table(spark.range(5), table)
    base = default_location(spark, table)
    overwrite_table(spark.range(6), table)
    for n in (4, 3):
        assert overwrite_table(spark.table(table).where(f"id < {n}"), table) == n
        place = table_location(spark, table)
        assert place.startswith(f"{base}-v") and shared_folder(spark) not in place
    assert remove_old_versions(spark, table) == 3
    assert remove_old_versions(spark, table) == 0
    assert rows(spark.table(table)) == [(0,), (1,), (2,)]


def test_published_tables_lie_in_the_shared_folder(spark):
    published = publish(spark.range(3), "numbers")
    assert rows(published) == [(0,), (1,), (2,)]
    assert all(shared_folder(spark) in f for f in published.inputFiles())


def test_what_a_run_published_can_be_removed(spark):
    outside = publish(spark.range(2), "outside")
    with own_run() as first:
        mine = publish(spark.range(3), "mine")
        with own_run() as second:
            other = publish(spark.range(4), "other")
        again = publish(spark.range(5), "again")
    assert all(f"/{first}/" in f for f in [*mine.inputFiles(), *again.inputFiles()])
    assert remove_run(spark, first) and not remove_run(spark, first)
    assert not Path(run_folder(spark, first)).exists()
    assert other.count() == 4 and outside.count() == 2 and remove_run(spark, second)
