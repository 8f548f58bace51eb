"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores. The tables are first copied
as several files each, as a cluster would hold them: one file of one row group is read by one task,
which would time a single core. Each query runs to completion twice without fetching its rows; the second time
counts, the first one is reported as ``cold``, and ``tasks`` is the number of tasks of its widest stage. ``stored``
times operators alone, over documents that have landed as several files: fastest and slowest of several runs.
``baseline`` compares, over the same documents, the extraction of one player's games with a row-at-a-time Python function,
both with the test of the text that spares most documents the parse and without it.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.documents import (
    documents_naming,
    latest_matches,
    match_index,
    quarantine,
    with_status,
)
from scoreloom.operators.games import (
    every_player_games,
    participant_games,
    player_games,
    routed,
    tracked_player_games,
)
from scoreloom.operators.strict import player_games_strict
from scoreloom.operators.stats import champion_stats
from scoreloom.schemas import GAME_SCHEMA
from scoreloom.session import local_session
from scoreloom.sources.shared import publish
from scoreloom.workload import matches
from scoreloom.workload.queries import PLAYER, QUERIES

HEADLINE = [
    "bronze_payloads",
    "payload_status",
    "latest_n_matches",
    "silver_player_games",
    "silver_all_participants",
    "silver_every_player",
    "silver_tracked_players",
    "gold_champion_stats",
    "gold_player_champion",
    "gold_upsert",
    "gold_upsert_players",
    "table_roundtrip",
    "stage_counts",
    "stream_gold",
    "champion_feed",
    "champion_metrics",
    "kpi_summary",
    "win_rate_histogram",
    "normal_curve",
    "tier_summary",
    "quadrants",
    "champion_options",
    "selected_champions",
    "radar_scores",
]


FILES = 16  # of each table and of the landed documents
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def split_tables(spark: SparkSession, sf_dir: str, to: str) -> str:
    """Copies of the tables in several files each."""
    for name in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        rows.repartition(FILES).write.parquet(f"{to}/{name}.parquet")
    return to


def widest_stages(events: str, spans: dict[str, tuple[float, float]]) -> dict[str, int]:
    """For each span of time, the tasks of the widest stage that began in it."""
    begun = []
    for log in Path(events).rglob("*"):
        for line in log.open() if log.is_file() else ():
            if '"SparkListenerStageCompleted"' in line:
                stage = json.loads(line)["Stage Info"]
                begun.append((stage["Submission Time"] / 1000, stage["Number of Tasks"]))
    return {name: max((n for t, n in begun if start <= t <= end), default=0) for name, (start, end) in spans.items()}


def seconds(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def python_form(documents: DataFrame) -> DataFrame:
    """One player's games with a Python function per row, as the point of comparison."""

    def game(payload: str) -> tuple | None:
        try:
            document = json.loads(payload)
            entries = document["info"]["participants"]
            mine = next(e for e in entries if e["puuid"] == PLAYER)
        except (ValueError, LookupError, TypeError, StopIteration):
            return None
        fields = ("championName", "kills", "deaths", "assists", "win")
        return (document["metadata"]["matchId"], *[mine[f] for f in fields])

    parsed = documents.select(F.udf(game, GAME_SCHEMA)("json_payload").alias("game"))
    return parsed.select("game.*").where(F.col("match_id").isNotNull())


RUNS = 4


def spread(forms: dict[str, Callable[[], DataFrame]]) -> dict[str, list[float]]:
    """Fastest and slowest of the runs after the first."""
    found = {}
    for name, form in forms.items():
        seconds(form)
        runs = [seconds(form) for _ in range(RUNS - 1)]
        found[name] = [min(runs), max(runs)]
    return found


def stored_operators(stored: DataFrame, damaged: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    players = stored.sparkSession.createDataFrame([(f"P{i}",) for i in range(1, 50, 10)], "puuid string")
    return {
        "status": lambda: with_status(damaged).groupBy("payload_status").count(),
        "quarantine": lambda: quarantine(damaged),
        "routed": lambda: routed(damaged)[1],
        "strict": lambda: player_games_strict(damaged, PLAYER),
        "listed_players": lambda: tracked_player_games(stored, players),
        "latest": lambda: latest_matches(match_index(stored)),
        "participants": lambda: participant_games(stored),
        "every_player": lambda: every_player_games(stored),
        "statistics": lambda: champion_stats(participant_games(stored)),
    }


def baseline(stored: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    return {
        "silver_native": lambda: player_games(stored, PLAYER),
        "silver_native_every_document_parsed": lambda: player_games(stored, PLAYER, text_test=False),
        "silver_python_udf": lambda: python_form(stored),
        "silver_python_udf_text_test": lambda: python_form(documents_naming(stored, PLAYER)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="scoreloom-bench-")
    events = f"{shared}/events"
    os.mkdir(events)
    spark = local_session(
        "scoreloom-bench",
        cpus=cpus,
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}",
            "spark.eventLog.compress": "false",
        },
    )
    tables = split_tables(spark, sf_dir, f"{shared}/tables")
    cold, warm, spans = {}, {}, {}
    for name in HEADLINE:
        cold[name] = seconds(lambda: QUERIES[name](spark, tables))
        began = time.time()
        warm[name] = seconds(lambda: QUERIES[name](spark, tables))
        spans[name] = (began, time.time())
    stored = publish(matches.documents(spark, tables).repartition(FILES), "documents")
    damaged = publish(matches.damaged_documents(spark, tables).repartition(FILES), "damaged")
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "cold": cold,
        "stored": spread(stored_operators(stored, damaged)),
        "baseline": spread(baseline(stored)),
    }
    spark.stop()
    result["tasks"] = widest_stages(events, spans)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
