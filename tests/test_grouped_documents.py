"""Known counts for documents of several participants, one document per order.

The registered queries build a document from each line. Here the lines of an order share one
document, so a player often occurs twice in it, and the counts are known in advance.
"""

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.tiers import tier_of
from scoreloom.operators.games import every_player_games, participant_games, player_games
from scoreloom.operators.stats import champion_stats
from scoreloom.sources.shared import publish
from scoreloom.workload import matches as m


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    lines = m.table(spark, sf_dir, "lineitem")
    parts = m.table(spark, sf_dir, "part")
    rows = lines.join(parts, lines.l_partkey == parts.p_partkey)
    rank = F.struct(
        "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("kills"),
        F.round(F.col("l_tax") * 100).cast("int").alias("assists"), m._own_entry().alias("entry"),
    )
    per_order = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(rank)).alias("lines"))
    text = F.to_json(
        F.struct(
            F.struct(F.concat(F.lit("M"), "l_orderkey").alias("matchId")).alias("metadata"),
            F.struct(F.col("lines.entry").alias("participants")).alias("info"),
        )
    )
    return publish(per_order.select(text.alias("json_payload")), "orders")


def test_counts(documents):
    assert documents.count() == 1473
    assert participant_games(documents).count() == 6000
    assert player_games(documents, "P7").count() == 500


def test_tiers(documents):
    rates = champion_stats(participant_games(documents)).select(
        tier_of(F.col("win_rate_pct")).alias("tier")
    )
    counts = {r.tier[0]: r["count"] for r in rates.groupBy("tier").count().collect()}
    assert counts == {"S": 17, "A": 10, "B": 10, "C": 25}


def test_one_player_equals_every_player(documents):
    every = every_player_games(documents)
    mine = every.where("puuid = 'P7'").drop("puuid")
    one = player_games(documents, "P7")
    assert mine.exceptAll(one).isEmpty() and one.exceptAll(mine).isEmpty()


def test_a_player_without_wins_in_a_champion_is_b_tier(documents):
    stats = champion_stats(player_games(documents, "P7")).where("win_rate_pct = 0")
    assert stats.count() == 2
    assert {r[0] for r in stats.select(tier_of(F.col("win_rate_pct"))).collect()} == {"B-Tier"}
