"""The registered queries: one function of ``(spark, sf_dir)`` per operator or panel table.

Results that come from transcendental functions or running variances are rounded to nine
decimals here, so that two engines agree; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.fixed_values import LATEST_MATCHES, SLIDER_INITIAL
from scoreloom.functions.text import sync_label
from scoreloom.operators import documents as docs
from scoreloom.operators import feed as feeds
from scoreloom.operators import games as extract
from scoreloom.operators import stats as statistics
from scoreloom.operators.strict import player_games_strict
from scoreloom.operators.upsert import check_source, upsert
from scoreloom.plans import daily, panels
from scoreloom.plans.refresh import WEIGHT, PanelState
from scoreloom.schemas import STATS_SCHEMA
from scoreloom.sources.buckets import BucketedTable
from scoreloom.sources.landing import land_documents, read_documents
from scoreloom.sources.shared import fresh_path, publish
from scoreloom.sources.tables import overwrite_table, scan_table
from scoreloom.streaming.index import LandingIndex
from scoreloom.streaming.latest import LatestMatches
from scoreloom.streaming.live import LiveStats
from scoreloom.workload import matches as m

Query = Callable[[SparkSession, str], DataFrame]

PLAYER = "P7"
HIGHLIGHTED = "red plate"
# Seven names of which one does not exist: six are valid, five are compared.
SELECTION = [
    "red plate",
    "Nobody",
    "Brand#7",
    "small widget",
    "hot rod",
    "blue gear",
    "old gizmo",
]
UNKNOWN_SELECTION = ["Nobody", "No One"]
PLACES = 9


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


# --- documents --------------------------------------------------------------------------


def bronze_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as text files and read back."""
    path = fresh_path(spark, "landing")
    land_documents(m.documents(spark, sf_dir), path)
    return read_documents(spark, path)


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.preview(m.documents(spark, sf_dir), "json_payload")


def payload_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = docs.with_status(m.damaged_documents(spark, sf_dir)).groupBy("payload_status")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def quarantined_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.quarantine(m.damaged_documents(spark, sf_dir))


def latest_n_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.latest_matches(docs.match_index(m.documents(spark, sf_dir)), LATEST_MATCHES)


def latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one player's latest matches, as the daily extraction takes them."""
    return daily.latest_documents(m.documents(spark, sf_dir), PLAYER)


def latest_documents_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by an index of the landed files, which is brought up to date after each of two landings."""
    landing = fresh_path(spark, "landing")
    index = LandingIndex(fresh_path(spark, "index"), landing)
    documents = publish(m.documents(spark, sf_dir), "documents")
    half = F.pmod(F.xxhash64("json_payload"), F.lit(2))
    for part in range(2):
        land_documents(documents.where(half == part), landing, mode="append")
        index.update(spark)
    return index.latest_documents(spark, PLAYER)


# --- games ------------------------------------------------------------------------------


def silver_player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.player_games(m.documents(spark, sf_dir), PLAYER)


def silver_damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.player_games(m.damaged_documents(spark, sf_dir), PLAYER)


def silver_damaged_documents_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_games_strict(m.damaged_documents(spark, sf_dir), PLAYER)


def silver_all_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.participant_games(m.documents(spark, sf_dir))


def silver_every_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.every_player_games(m.documents(spark, sf_dir))


def silver_tracked_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = m.table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    players = solvent.select(F.concat(F.lit("P"), F.col("s_suppkey")).alias("puuid"))
    return extract.tracked_player_games(m.documents(spark, sf_dir), players)


def silver_listed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short list, whose ids are looked for in the texts before a document is parsed."""
    some = m.table(spark, sf_dir, "region").select(F.concat(F.lit("P"), F.col("r_regionkey") * 2 + 1).alias("puuid"))
    return extract.tracked_player_games(m.documents(spark, sf_dir), some)


def routed_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games of the one pass that also finds the documents without games."""
    return extract.routed(m.damaged_documents(spark, sf_dir))[0]


def routed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other part of that pass."""
    return extract.routed(m.damaged_documents(spark, sf_dir))[1]


# --- statistics -------------------------------------------------------------------------


def gold_champion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to statistics, end to end."""
    found = statistics.champion_stats(silver_all_participants(spark, sf_dir))
    return statistics.most_played_first(found)


def gold_one_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.champion_stats(silver_player_games(spark, sf_dir))


def gold_player_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.player_champion_stats(silver_every_player(spark, sf_dir))


def gold_summed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics added up from the sums of separate sets of games."""
    sums = statistics.game_sums(m.games(spark, sf_dir), "champion", "l_returnflag")
    return statistics.stats_from_sums(statistics.add_sums(sums.drop("l_returnflag")), "champion")


def _two_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Games of an earlier and a later window."""
    played = m.games(spark, sf_dir)
    return played.where("l_returnflag <> 'R'"), played.where("l_returnflag = 'R'")


def gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a later window into those of an earlier one; together they are all games."""
    earlier, later = _two_windows(spark, sf_dir)
    target = publish(statistics.champion_stats(earlier), "target")
    source = publish(statistics.champion_stats(later), "source")
    check_source(target, source)
    source.createOrReplaceTempView("v_new_stats")
    return upsert(target, spark.table("v_new_stats"))


def gold_upsert_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per player and character: rows are replaced, added and kept."""
    earlier, later = _two_windows(spark, sf_dir)
    target = publish(statistics.player_champion_stats(earlier), "target")
    source = publish(statistics.player_champion_stats(later), "source")
    return upsert(target, source, key=["puuid", "champion"])


def gold_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of ``gold_upsert`` into a bucketed table, of which only the touched buckets are rewritten."""
    earlier, later = _two_windows(spark, sf_dir)
    table = BucketedTable(fresh_path(spark, "bucketed"), STATS_SCHEMA, ("champion",), buckets=32)
    table.replace(statistics.champion_stats(earlier))
    table.upsert(statistics.champion_stats(later))
    return table.read(spark)


def gold_upsert_players_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per player and character."""
    earlier, later = _two_windows(spark, sf_dir)
    before = statistics.player_champion_stats(earlier)
    table = BucketedTable(fresh_path(spark, "bucketed"), before.schema, ("puuid", "champion"), buckets=32)
    table.replace(before)
    table.upsert(statistics.player_champion_stats(later))
    return table.read(spark)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice; the second write replaces the first."""
    name = f"games_{uuid4().hex}"
    played = m.games(spark, sf_dir).drop("l_returnflag", "l_linestatus")
    overwrite_table(played.where("win"), name)
    overwrite_table(played, name)
    return scan_table(spark, name)


def table_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is moved by an overwrite from itself and then gets other columns and another format."""
    name = f"games_{uuid4().hex}"
    overwrite_table(m.games(spark, sf_dir), name)
    overwrite_table(scan_table(spark, name).where("match_id IS NOT NULL"), name)
    overwrite_table(statistics.champion_stats(scan_table(spark, name)), name, fmt="orc")
    return scan_table(spark, name)


def _daily_counts(spark: SparkSession, sf_dir: str, latest: int | None) -> DataFrame:
    landing = fresh_path(spark, "landing")
    land_documents(m.documents(spark, sf_dir), landing)
    suffix = uuid4().hex
    names = daily.Tables(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")
    written = daily.run_daily(spark, landing, PLAYER, names, latest)
    return spark.createDataFrame(list(written.items()), "stage string, n bigint")


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each step of a first daily run over all landed documents, which are read where they lie."""
    return _daily_counts(spark, sf_dir, None)


def stage_counts_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the newest matches of one player."""
    return _daily_counts(spark, sf_dir, LATEST_MATCHES)


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents landed as files in three goes, each counted as a batch of the stream."""
    landing = fresh_path(spark, "landing")
    live = LiveStats(fresh_path(spark, "live"))
    documents = publish(m.documents(spark, sf_dir), "documents")
    part = F.pmod(F.xxhash64("json_payload"), F.lit(3))
    for third in range(3):
        land_documents(documents.where(part == third), landing, mode="append")
        live.start(spark, landing, once=True).awaitTermination()
    return live.stats(spark)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every player's latest matches after the documents have landed in three goes, a part of them twice."""
    landing = fresh_path(spark, "landing")
    stream = LatestMatches(fresh_path(spark, "latest"))
    documents = publish(m.documents(spark, sf_dir), "documents")
    part = F.pmod(F.xxhash64("json_payload"), F.lit(4))
    for go in (part.isin(0, 3), part.isin(1, 3), part == 2):
        land_documents(documents.where(go), landing, mode="append")
        stream.start(spark, landing, once=True).awaitTermination()
    return stream.latest(spark)


def stream_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of win rates from the panels' state, which each of three landings refreshes."""
    landing = fresh_path(spark, "landing")
    live, state = LiveStats(fresh_path(spark, "live")), PanelState(fresh_path(spark, "panels"))
    documents = publish(m.documents(spark, sf_dir), "documents")
    part = F.pmod(F.xxhash64("json_payload"), F.lit(3))
    for third in range(3):
        land_documents(documents.where(part == third), landing, mode="append")
        live.start(spark, landing, once=True).awaitTermination()
        state.refresh(feeds.champion_feed(live.changed_stats(spark)))
    return panels.rate_histogram(state.rates(spark), WEIGHT)


# --- feed -------------------------------------------------------------------------------


def champion_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.best_first(feeds.champion_feed(m.stats(spark, sf_dir)))


def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    untidy = feeds.champion_feed(m.stats(spark, sf_dir)).toDF(
        " Champion ", "WIN_RATE_PCT", "Matches_Played "
    )
    return feeds.normalize_columns(untidy)


def feed_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is served for a good source, an empty one, an incomplete one and a missing table."""
    feed = m.feed(spark, sf_dir)
    sources = {
        "good": feed,
        "empty": feed.where("matches_played < 0"),
        "incomplete": feed.drop("win_rate_pct"),
        "missing": f"no_such_table_{uuid4().hex}",
    }
    served = [
        feeds.feed_or_fallback(spark, source).select(F.lit(case).alias("source"), "*")
        for case, source in sources.items()
    ]
    result = served[0]
    for other in served[1:]:
        result = result.unionByName(other)
    return result


def feed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is served when a good feed is followed by one that fails while its rows are read."""
    snapshots = fresh_path(spark, "snapshots")
    feed = feeds.champion_feed(m.stats(spark, sf_dir))
    first = feeds.feed_or_fallback(spark, feed, snapshots)
    failing = feed.withColumn("win_rate_pct", F.when(F.col("matches_played") > 0, F.raise_error(F.lit("no rate")).cast("double")))
    served = {"good": first, "failing": feeds.feed_or_fallback(spark, failing, snapshots)}
    shown = [rows.select(F.lit(case).alias("source"), *feed.columns) for case, rows in served.items()]
    return shown[0].unionByName(shown[1])


def champion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.metrics(spark, sf_dir)


def champion_metrics_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a feed with two rows: all games, by line status."""
    by_status = m.games(spark, sf_dir).withColumn("champion", F.col("l_linestatus"))
    feed = publish(feeds.champion_feed(statistics.champion_stats(by_status)), "feed")
    return feeds.champion_metrics(feed)


def feed_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_records(m.metrics(spark, sf_dir))


def as_of_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = m.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("as_of"))
    return latest.select(sync_label(F.col("as_of")).alias("label"))


# --- panels -----------------------------------------------------------------------------


def _panel(build: Callable[[DataFrame], DataFrame], *rounded: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(build(m.metrics(spark, sf_dir)), *rounded)

    return query


def _bubble_sizes(metrics: DataFrame) -> DataFrame:
    points = panels.volume_points(metrics)
    return points.select("champion", "matches_played", "win_rate_pct", "bubble_size")


def _quadrants(metrics: DataFrame) -> DataFrame:
    points = panels.volume_points(metrics)
    return points.select("champion", "matches_played", "win_rate_pct", "quadrant")


def _bubble_highlight(metrics: DataFrame) -> DataFrame:
    points = panels.volume_points(metrics, HIGHLIGHTED)
    return points.select("champion", "bubble_size", "symbol", "above_baseline")


def _labels(metrics: DataFrame) -> DataFrame:
    """Bar texts of every champion."""
    return panels.comparison_rows(metrics).select("champion", "delta", "label", "delta_label")


PANELS: dict[str, Query] = {
    "win_rate_range": _panel(partial(panels.in_range, rate_range=SLIDER_INITIAL)),
    "kpi_summary": _panel(panels.kpi_summary, "avg_wr", "avg_delta", "top_minus_avg"),
    "kpi_spark_all": _panel(panels.spark_all),
    "kpi_spark_top5": _panel(panels.spark_top5),
    "tier_counts_zero_filled": _panel(panels.tier_counts),
    "top10_win_rate": _panel(panels.top_rates),
    "axis_bounds": _panel(panels.axis_bounds),
    "volume_median": _panel(panels.volume_split),
    "bubble_sizes": _panel(_bubble_sizes),
    "bubble_highlight": _panel(_bubble_highlight),
    "quadrants": _panel(_quadrants),
    "win_rate_histogram": _panel(panels.rate_histogram),
    "win_rate_moments": _panel(panels.rate_moments, "mean_wr", "std_wr"),
    "normal_curve": _panel(panels.normal_curve, "x", "y"),
    "tier_summary": _panel(panels.tier_summary, "avg_wr"),
    "tier_attributes": _panel(panels.tier_attributes),
    "champion_options": _panel(panels.options),
    "champion_icon_url": _panel(panels.icons),
    "champion_lookup": _panel(partial(panels.champion_row, champion=HIGHLIGHTED)),
    "default_selection": _panel(partial(panels.default_selection, rate_range=SLIDER_INITIAL)),
    "selection_places": _panel(partial(panels.selected_champions, selected=SELECTION)),
    "selected_champions": _panel(partial(panels.deep_dive, selected=SELECTION)),
    "selected_unknown": _panel(
        partial(panels.deep_dive, selected=UNKNOWN_SELECTION, rate_range=SLIDER_INITIAL)
    ),
    "selected_labels": _panel(_labels),
    "radar_scores": _panel(partial(panels.radar, selected=SELECTION)),
    "radar_default": _panel(partial(panels.radar, selected=[])),
}

QUERIES: dict[str, Query] = {
    **{
        query.__name__: query
        for query in (
            bronze_payloads,
            bronze_preview,
            payload_status,
            quarantined_payloads,
            latest_n_matches,
            latest_documents,
            latest_documents_indexed,
            silver_player_games,
            silver_damaged_documents,
            silver_damaged_documents_strict,
            silver_all_participants,
            silver_every_player,
            silver_tracked_players,
            silver_listed_players,
            routed_games,
            routed_quarantine,
            gold_champion_stats,
            gold_one_player,
            gold_player_champion,
            gold_summed_batches,
            gold_upsert,
            gold_upsert_players,
            gold_upsert_bucketed,
            gold_upsert_players_bucketed,
            table_roundtrip,
            table_schema_change,
            stage_counts,
            stage_counts_latest,
            stream_gold,
            stream_latest,
            stream_panels,
            champion_feed,
            normalize_columns,
            feed_or_fallback,
            feed_snapshots,
            champion_metrics,
            champion_metrics_small,
            feed_records_json,
            as_of_label,
        )
    },
    **PANELS,
}
