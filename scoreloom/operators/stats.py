"""Per-champion statistics, in one pass or from sums that can be added up over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("kills", "deaths", "assists")


def game_sums(games: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums per key. Partial sums are formed before the shuffle."""
    averages = [
        part
        for m in MEASURES
        for part in (F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}"))
    ]
    return games.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_partidas"),
        F.sum(F.col("win").cast("int")).alias("vitorias"),
        *averages,
    )


def add_sums(*parts: DataFrame, keys: tuple[str, ...] = ("champion",)) -> DataFrame:
    """Add up tables of ``game_sums``. A sum stays null when no part has a value."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    sums = [c for c in together.columns if c not in keys]
    return together.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def stats_from_sums(sums: DataFrame, *keys: str) -> DataFrame:
    """Averages and win rate, each to one decimal, from ``game_sums``."""

    def average(measure: str) -> Column:
        mean = F.try_divide(F.col(f"sum_{measure}"), F.col(f"n_{measure}"))
        return F.round(mean, 1).alias(f"media_{measure}")

    return sums.select(
        *keys,
        "total_partidas",
        "vitorias",
        *[average(m) for m in MEASURES],
        F.round(F.col("vitorias") / F.col("total_partidas") * 100, 1).alias("win_rate_pct"),
    )


def champion_stats(games: DataFrame) -> DataFrame:
    """Games, wins, averages and win rate per champion.

    A null ``win`` counts as a game and not as a win; with no known result at all, wins and
    win rate are null.
    """
    return stats_from_sums(game_sums(games, "champion"), "champion")


def player_champion_stats(games: DataFrame) -> DataFrame:
    """The same per player and champion."""
    return stats_from_sums(game_sums(games, "puuid", "champion"), "puuid", "champion")


def most_played_first(stats: DataFrame) -> DataFrame:
    """Display order; not for tables that are joined or merged afterwards."""
    return stats.orderBy(F.desc("total_partidas"), "champion")
