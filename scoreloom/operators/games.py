"""Per-game rows from match documents, with JSON and array functions only.

Each form parses a document once and emits its rows with ``inline``. The not-null test on
the match id is part of the emitted array rather than a later filter, because a filter
would be pushed below the projection and parse the JSON a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.documents import OK, may_name, may_name_any, parsed_status, with_parsed
from scoreloom.schemas import PLAYER_GAME_SCHEMA
from scoreloom.sources.shared import fresh_path

PARTICIPANTS = "doc.info.participants"
GAMES = PLAYER_GAME_SCHEMA.simpleString()
SHORT_LIST = 1000  # players whose ids are looked for in the texts


def _game(p: Column, with_player: bool) -> Column:
    player = [p["puuid"].alias("puuid")] if with_player else []
    return F.struct(
        *player,
        F.col("match_id").alias("match_id"),
        p["championName"].alias("champion"),
        p["kills"].alias("kills"),
        p["deaths"].alias("deaths"),
        p["assists"].alias("assists"),
        p["win"].alias("win"),
    )


def _emit(documents: DataFrame, games: Column) -> DataFrame:
    return documents.select(F.inline(F.when(F.col("match_id").isNotNull(), games)))


def player_games(documents: DataFrame, puuid: str, text_test: bool = True) -> DataFrame:
    """One row per match of one player: the first participant with that id.

    Documents whose text cannot name the player are not parsed, unless ``text_test`` is off.
    """
    first = F.slice(F.filter(PARTICIPANTS, lambda p: p["puuid"] == F.lit(puuid)), 1, 1)
    game = F.transform(first, lambda p: _game(p, with_player=False))
    return _emit(with_parsed(documents, where=may_name(puuid) if text_test else None), game)


def participant_games(documents: DataFrame) -> DataFrame:
    """One row per participant entry of every match, with the player id."""
    present = F.filter(PARTICIPANTS, lambda p: p.isNotNull())
    entries = F.transform(present, lambda p: _game(p, with_player=True))
    return _emit(with_parsed(documents), entries)


def every_player_games(documents: DataFrame, where: Column | None = None) -> DataFrame:
    """``player_games`` for all players at once: the first entry per player and document.

    Entries are sorted by player and position within their own document, and an entry is
    kept when the one before it belongs to another player. ``where`` names the payloads worth parsing.
    """
    entries = F.transform(
        F.filter(PARTICIPANTS, lambda p: p["puuid"].isNotNull()),
        lambda p, i: F.struct(p["puuid"].alias("puuid"), i.alias("position"), p.alias("entry")),
    )
    ranked = with_parsed(documents, where).select("match_id", F.sort_array(entries).alias("ranked"))

    def is_first(entry: Column, i: Column) -> Column:
        before = F.get("ranked", i - 1)
        return before.isNull() | (before["puuid"] != entry["puuid"])

    firsts = F.transform(F.filter("ranked", is_first), lambda e: _game(e["entry"], with_player=True))
    return _emit(ranked, firsts)


def tracked_player_games(documents: DataFrame, players: DataFrame) -> DataFrame:
    """``player_games`` for the players listed in the ``puuid`` column of ``players``.

    With a short list only documents whose text can name one of them are parsed. The driver takes up to
    ``SHORT_LIST`` ids to see whether it is one; a longer list is not looked up in the texts, as most documents would
    name somebody on it. The rows are the same.

    No join hint: Spark broadcasts the list only when its size allows, and otherwise splits
    a player that holds a large share of the rows over tasks.
    """
    listed = players.select("puuid").where("puuid IS NOT NULL")
    some = [r[0] for r in listed.limit(SHORT_LIST + 1).collect()]
    where = may_name_any(sorted(set(some))) if len(some) <= SHORT_LIST else None
    return every_player_games(documents, where).join(listed, "puuid", "left_semi")


def routed(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All participants' games, and the documents that yield none with the reason, from one parse.

    As ``participant_games`` and ``quarantine`` give them. Both are published by one pass over the documents and lie
    apart, so each reader opens its own part.
    """
    parsed = with_parsed(documents).withColumn("payload_status", parsed_status())
    present = F.filter(PARTICIPANTS, lambda p: p.isNotNull())
    no_text = F.lit(None).cast("string")
    games = F.transform(
        present,
        lambda p: F.struct(
            F.lit(False).alias("rejected"),
            no_text.alias("json_payload"),
            no_text.alias("payload_status"),
            _game(p, with_player=True).alias("game"),
        ),
    )
    reason = F.struct(
        F.lit(True).alias("rejected"), "json_payload", "payload_status", F.lit(None).cast(GAMES).alias("game")
    )
    emitted = F.when(F.col("payload_status") == OK, games).otherwise(F.array(reason))
    spark = documents.sparkSession
    path = fresh_path(spark, "routed")
    rows = parsed.select(F.inline(emitted))
    rows.write.partitionBy("rejected").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    good = stored.where("NOT rejected").select("game.*")
    return good, stored.where("rejected").select("json_payload", "payload_status")
