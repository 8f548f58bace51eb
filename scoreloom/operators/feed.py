"""The feed behind the dashboard: names, contract, fallback and derived metrics."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.fixed_values import (
    BASELINE_RATE,
    DEFAULT_MATCHES_PLAYED,
    DEFAULT_TIER,
    SMALL_FEED_ROWS,
    SMALL_FEED_SCORE,
)
from scoreloom.functions.overall import with_one_row
from scoreloom.functions.scores import min_max_score
from scoreloom.functions.tiers import tier_of
from scoreloom.schemas import FEED_SCHEMA
from scoreloom.sources.demo import demo_feed
from scoreloom.sources.files import children, delete, is_complete
from scoreloom.sources.shared import publish
from scoreloom.sources.tables import scan_table

logger = logging.getLogger(__name__)

REQUIRED_COLUMNS = frozenset(FEED_SCHEMA.names)
KEPT_SNAPSHOTS = 3  # the one served, and those that a reader may still hold
PLACES = 12  # of a snapshot's number in its name


def champion_feed(stats: DataFrame) -> DataFrame:
    """``champion, win_rate_pct, matches_played`` from the statistics table."""
    played = "matches_played" if "matches_played" in stats.columns else "total_partidas"
    return stats.select(
        "champion",
        "win_rate_pct",
        F.coalesce(played, F.lit(DEFAULT_MATCHES_PLAYED)).alias("matches_played"),
    )


def best_first(df: DataFrame) -> DataFrame:
    """Highest win rate first, unknown rates last, ties by champion."""
    return df.orderBy(F.desc_nulls_last("win_rate_pct"), "champion")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case without surrounding blanks."""
    return df.toDF(*[name.lower().strip() for name in df.columns])


def meets_contract(df: DataFrame) -> bool:
    return REQUIRED_COLUMNS <= set(df.columns)


def feed_or_fallback(
    spark: SparkSession,
    source: str | DataFrame | Callable[[], DataFrame],
    snapshots: str | None = None,
) -> DataFrame:
    """The feed of a statistics table, or the last good one, or the demo feed when it cannot serve.

    ``source`` is a table name, a DataFrame, or a function returning one. A feed is served only after it was
    read and written in full, from what was written, so whatever reads it cannot meet a failure of the
    source. The feed is no good when anything fails on the way, which is logged, when required columns are missing,
    and when there are no rows.

    ``snapshots`` is a folder, which all executors must share, that keeps the last good feeds; without it the feed is published like
    other intermediates and there is no earlier one.
    """
    try:
        if isinstance(source, str):
            feed = champion_feed(scan_table(spark, source))
        else:
            feed = source() if callable(source) else source
        feed = normalize_columns(feed)
        served = _stored(spark, feed, snapshots) if meets_contract(feed) else None
        if served is not None:
            return served
        problem = f"it needs rows and the columns {', '.join(sorted(REQUIRED_COLUMNS))}"
    except Exception as error:  # whatever it is, the dashboard has to show something
        problem = str(error).split("\n", 1)[0]
    earlier = _snapshots(spark, snapshots) if snapshots else []
    if earlier:
        logger.warning("serving the last good feed: %s", problem)
        return spark.read.parquet(f"{snapshots}/{earlier[-1]}")
    logger.warning("serving the demo feed: %s", problem)
    return demo_feed(spark)


def _stored(spark: SparkSession, feed: DataFrame, snapshots: str | None) -> DataFrame | None:
    """The feed read from a full copy of it, None where it has no rows."""
    if snapshots is None:
        stored = publish(feed, "feed")
        return None if stored.isEmpty() else stored
    earlier = _snapshots(spark, snapshots)
    name = f"{int(earlier[-1][:PLACES]) + 1 if earlier else 0:0{PLACES}d}-{uuid.uuid4().hex}"
    path = f"{snapshots}/{name}"
    feed.write.parquet(path)
    stored = spark.read.schema(feed.schema).parquet(path)
    if stored.isEmpty():
        delete(spark, path)
        return None
    for old in earlier[: 1 - KEPT_SNAPSHOTS]:
        delete(spark, f"{snapshots}/{old}")
    return stored


def _snapshots(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete snapshots, the latest one last."""
    return [n for n in sorted(children(spark, folder)) if is_complete(spark, f"{folder}/{n}")]


def champion_metrics(feed: DataFrame) -> DataFrame:
    """Add ``tier``, ``win_rate_delta`` and the two 0 to 100 scores.

    A feed of fewer than three rows gets fixed tier and scores.
    """
    rate, played, over = F.col("win_rate_pct"), F.col("matches_played"), F.col("over_all")
    values = with_one_row(
        feed,
        "over_all",
        n=F.count(F.lit(1)),
        rate_min=F.min(rate),
        rate_max=F.max(rate),
        played_min=F.min(played),
        played_max=F.max(played),
    )
    small = over["n"] < SMALL_FEED_ROWS
    rate_score = min_max_score(rate, over["rate_min"], over["rate_max"])
    played_score = min_max_score(played, over["played_min"], over["played_max"])
    return values.select(
        *feed.columns,
        F.when(small, DEFAULT_TIER).otherwise(tier_of(rate)).alias("tier"),
        (rate - BASELINE_RATE).alias("win_rate_delta"),
        F.when(small, SMALL_FEED_SCORE).otherwise(rate_score).alias("wr_normalized"),
        F.when(small, SMALL_FEED_SCORE).otherwise(played_score).alias("pop_normalized"),
    )


def feed_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON record that has all its fields, null ones too."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
