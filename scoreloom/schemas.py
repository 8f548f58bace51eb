"""Schemas of the raw, per-game, per-champion and feed tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([T.StructField("json_payload", T.StringType())])

PARTICIPANT_SCHEMA = T.StructType(
    [
        T.StructField("puuid", T.StringType()),
        T.StructField("championName", T.StringType()),
        T.StructField("kills", T.IntegerType()),
        T.StructField("deaths", T.IntegerType()),
        T.StructField("assists", T.IntegerType()),
        T.StructField("win", T.BooleanType()),
    ]
)

# Only the fields that are read; from_json skips the rest of the document.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("metadata", T.StructType([T.StructField("matchId", T.StringType())])),
        T.StructField(
            "info",
            T.StructType([T.StructField("participants", T.ArrayType(PARTICIPANT_SCHEMA))]),
        ),
    ]
)

# For the list of a player's matches: ids, end time and player ids only.
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("metadata", T.StructType([T.StructField("matchId", T.StringType())])),
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("gameEndTimestamp", T.LongType()),
                    T.StructField(
                        "participants",
                        T.ArrayType(T.StructType([T.StructField("puuid", T.StringType())])),
                    ),
                ]
            ),
        ),
    ]
)

GAME_SCHEMA = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("champion", T.StringType()),
        T.StructField("kills", T.IntegerType()),
        T.StructField("deaths", T.IntegerType()),
        T.StructField("assists", T.IntegerType()),
        T.StructField("win", T.BooleanType()),
    ]
)

PLAYER_GAME_SCHEMA = T.StructType([T.StructField("puuid", T.StringType()), *GAME_SCHEMA.fields])

# Sums that can be added up over batches; statistics follow from them.
SUMS_SCHEMA = T.StructType(
    [T.StructField("champion", T.StringType())]
    + [
        T.StructField(name, T.LongType())
        for name in (
            "total_partidas",
            "vitorias",
            "sum_kills",
            "n_kills",
            "sum_deaths",
            "n_deaths",
            "sum_assists",
            "n_assists",
        )
    ]
)

STATS_SCHEMA = T.StructType(
    [
        T.StructField("champion", T.StringType()),
        T.StructField("total_partidas", T.LongType()),
        T.StructField("vitorias", T.LongType()),
        T.StructField("media_kills", T.DoubleType()),
        T.StructField("media_deaths", T.DoubleType()),
        T.StructField("media_assists", T.DoubleType()),
        T.StructField("win_rate_pct", T.DoubleType()),
    ]
)

FEED_SCHEMA = T.StructType(
    [
        T.StructField("champion", T.StringType()),
        T.StructField("win_rate_pct", T.DoubleType()),
        T.StructField("matches_played", T.LongType()),
    ]
)
