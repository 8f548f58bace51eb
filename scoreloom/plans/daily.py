"""The daily run: landed documents to raw table, game table and statistics table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.fixed_values import LATEST_MATCHES
from scoreloom.operators.documents import (
    documents_naming,
    documents_of,
    latest_matches,
    match_index,
)
from scoreloom.operators.games import player_games
from scoreloom.operators.stats import champion_stats
from scoreloom.operators.upsert import upsert_table
from scoreloom.sources.landing import read_documents
from scoreloom.sources.shared import publish
from scoreloom.sources.tables import finish_overwrite, overwrite_table, remove_old_versions, scan_table
from scoreloom.streaming.index import LandingIndex


@dataclass(frozen=True)
class Tables:
    """Names of the three tables of a run."""

    raw: str = "bronze_matches"
    games: str = "silver_games"
    stats: str = "gold_champion_stats"


def load_raw(documents: DataFrame, tables: Tables) -> int:
    return overwrite_table(documents, tables.raw)


def load_games(raw: DataFrame, puuid: str, tables: Tables) -> int:
    return overwrite_table(player_games(raw, puuid), tables.games)


def load_stats(spark: SparkSession, tables: Tables) -> int | None:
    return upsert_table(spark, tables.stats, champion_stats(scan_table(spark, tables.games)))


def latest_documents(documents: DataFrame, puuid: str, n: int = LATEST_MATCHES) -> DataFrame:
    """One document for each of a player's newest matches.

    The list of matches is published, so that its size is known when documents are picked.
    """
    mine = documents_naming(documents, puuid)
    index = match_index(mine).where(F.col("puuid") == F.lit(puuid))
    return documents_of(mine, publish(latest_matches(index, n), "latest"))


def run_daily(
    spark: SparkSession,
    landing: str,
    puuid: str,
    tables: Tables = Tables(),
    latest: int | None = LATEST_MATCHES,
    index: LandingIndex | None = None,
) -> dict[str, int | None]:
    """Run the three steps in order and return the rows of each.

    The raw table takes the player's ``latest`` newest matches. With None the whole landing folder
    is the raw data: it is counted and read where it lies, not copied. With an ``index`` of the landing folder only
    what has landed since the last run is parsed to find them, and only the files that hold them are read again; without it all is.
    Tables keep one version
    before the present one, which the next run removes. A step that fails raises, so the steps
    after it do not run. Steps meet only in tables; each may be run again by itself with the
    same result.
    """
    for table in (tables.raw, tables.games, tables.stats):
        if finish_overwrite(spark, table):
            remove_old_versions(spark, table)
    landed = read_documents(spark, landing)
    if latest is None:
        raw, n_raw = landed, landed.count()
    else:
        if index is not None:
            index.update(spark)
            newest = index.latest_documents(spark, puuid, latest)
        else:
            newest = latest_documents(landed, puuid, latest)
        n_raw = load_raw(newest, tables)
        raw = scan_table(spark, tables.raw)
    return {
        "bronze": n_raw,
        "silver": load_games(raw, puuid, tables),
        "gold": load_stats(spark, tables),
    }
