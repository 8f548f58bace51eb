"""Statistics per champion and per player, in one pass and added up."""

import random

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import stats
from scoreloom.schemas import PLAYER_GAME_SCHEMA, STATS_SCHEMA


def games(spark, rows):
    """Rows of champion, kills, deaths, assists, win."""
    return spark.createDataFrame([("p", "m", *row) for row in rows], PLAYER_GAME_SCHEMA)


def test_counts_averages_and_rate(spark):
    found = stats.champion_stats(
        games(spark, [("X", 1, 0, 10, True), ("X", 2, 1, 5, False), ("X", 4, None, 3, None)])
    ).collect()
    assert [tuple(r) for r in found] == [("X", 3, 1, 2.3, 0.5, 6.0, 33.3)]


def test_schema(spark):
    found = stats.champion_stats(games(spark, [("X", 1, 0, 10, True)])).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in STATS_SCHEMA]


def test_unknown_results_and_unknown_champion(spark):
    found = stats.champion_stats(games(spark, [(None, None, None, None, None)])).collect()
    assert [tuple(r) for r in found] == [(None, 1, None, None, None, None, None)]


def test_half_up_rounding(spark):
    rows = [("X", kills, 0, 0, True) for kills in (2, 2, 2, 3)]
    assert stats.champion_stats(games(spark, rows)).first().media_kills == 2.3


def test_no_games(spark):
    assert stats.champion_stats(games(spark, [])).count() == 0


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.choice(["X", "Y", "Z", None]),
            rng.choice([None, *range(20)]),
            rng.randrange(15),
            rng.randrange(25),
            rng.choice([True, False, None]),
        )
        for _ in range(2000)
    ]
    return games(spark, rows)


def test_added_sums_equal_one_pass(spark, many):
    parts = [
        stats.game_sums(many.where(F.abs(F.hash("kills", "deaths")) % 3 == i), "champion")
        for i in range(3)
    ]
    added = stats.stats_from_sums(stats.add_sums(*parts), "champion")
    assert sorted(added.collect(), key=str) == sorted(stats.champion_stats(many).collect(), key=str)


def test_result_does_not_depend_on_partitions(spark, many):
    one = stats.champion_stats(many.coalesce(1)).collect()
    more = stats.champion_stats(many.repartition(13)).collect()
    assert sorted(one, key=str) == sorted(more, key=str)


def test_wins_never_exceed_games(many):
    assert stats.champion_stats(many).where("vitorias > total_partidas").isEmpty()


def test_averages_equal_the_builtin_average(many):
    builtin = many.groupBy("champion").agg(
        *[F.round(F.avg(c), 1).alias(f"media_{c}") for c in stats.MEASURES]
    )
    ours = stats.champion_stats(many).select(*builtin.columns)
    assert sorted(ours.collect(), key=str) == sorted(builtin.collect(), key=str)


def test_player_champion_adds_up_to_champion(many):
    per_player = stats.player_champion_stats(many.withColumn("puuid", F.hash("kills").cast("string")))
    total = per_player.groupBy("champion").agg(F.sum("total_partidas").alias("total_partidas"))
    whole = stats.champion_stats(many).select("champion", "total_partidas")
    assert sorted(total.collect(), key=str) == sorted(whole.collect(), key=str)


def test_partial_sums_before_the_shuffle(many, plan_of):
    plan = plan_of(stats.champion_stats(many))
    assert "partial_sum" in plan and plan.count("Exchange") == 1
