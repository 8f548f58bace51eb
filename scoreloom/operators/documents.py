"""Operators on raw documents: status, quarantine, preview, and a player's latest matches."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.fixed_values import LATEST_MATCHES, PREVIEW_ROWS
from scoreloom.schemas import DOCUMENT_SCHEMA, INDEX_SCHEMA

# Single-quoted text is not JSON for the sources we read.
JSON_OPTIONS = {"allowSingleQuotes": "false"}

# A text value, or a number or other word, after the key of a player id; an object or array is cut short.
PLAYER_ID = r'"puuid"\s*:\s*("[^"]*"|[^\s",\]}]+)'
FEW_PLAYERS = 4  # that are searched one by one

GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"

OK = "ok"
INVALID_JSON = "invalid_json"
API_ERROR = "api_error"
NO_PARTICIPANTS = "no_participants"
NO_MATCH_ID = "no_match_id"
NO_USABLE_PARTICIPANTS = "no_usable_participants"


def with_parsed(documents: DataFrame, where: Column | None = None) -> DataFrame:
    """Add the parsed document ``doc`` and the ``match_id`` of each payload.

    ``match_id`` is null for a document that carries a null id or an unusable ``metadata``,
    and an empty string when ``metadata`` or ``matchId`` is absent. from_json gives null for
    both, so the absent case looks at the object keys; that runs only where the id is null.

    ``where`` names the payloads worth parsing. It guards the parse instead of filtering rows,
    because a filter is moved below whatever computes the payload and computes it again.
    """
    payload = F.col("json_payload")
    wanted = payload if where is None else F.when(where, payload)
    metadata = F.get_json_object(payload, "$.metadata")
    metadata_absent = ~F.array_contains(F.json_object_keys(payload), "metadata")
    id_absent = ~F.array_contains(F.json_object_keys(metadata), "matchId")
    has_entries = F.col("doc.info.participants").isNotNull()
    return documents.withColumn("doc", F.from_json(wanted, DOCUMENT_SCHEMA, JSON_OPTIONS)).withColumn(
        "match_id",
        F.coalesce(
            F.col("doc.metadata.matchId"),
            F.when(has_entries & (metadata_absent | id_absent), F.lit("")),
        ),
    )


def parsed_status() -> Column:
    """Of a parsed document, whether games can be extracted, and if not, why.

    Exactly the documents that give participant rows are ``ok``: those with a match id, which
    may be empty, and an entry that is an object.
    """
    keys = F.json_object_keys("json_payload")
    entries = F.col("doc.info.participants")
    listed = F.coalesce(F.size(entries) > 0, F.lit(False))
    usable = F.coalesce(F.exists(entries, lambda p: p.isNotNull()), F.lit(False))
    named = F.col("match_id").isNotNull()
    return (
        F.when(usable & named, OK)
        .when(keys.isNull(), INVALID_JSON)
        .when(~listed & F.array_contains(keys, "status"), API_ERROR)
        .when(~listed, NO_PARTICIPANTS)
        .when(~named, NO_MATCH_ID)
        .otherwise(NO_USABLE_PARTICIPANTS)
    )


def with_status(documents: DataFrame) -> DataFrame:
    """Add ``payload_status``, see ``parsed_status``."""
    return with_parsed(documents).withColumn("payload_status", parsed_status()).drop("doc", "match_id")


def quarantine(documents: DataFrame) -> DataFrame:
    """The documents that yield no games, with the reason.

    The choice is part of the emitted array, as a filter on a parsed value parses twice.
    """
    row = F.array(F.struct("json_payload", "payload_status"))
    return with_status(documents).select(F.inline(F.when(F.col("payload_status") != OK, row)))


def preview(df: DataFrame, *order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first few rows in a fixed order."""
    return df.orderBy(*order).limit(rows)


def match_index(documents: DataFrame, *also: str) -> DataFrame:
    """One row per player and match, and per value of the columns ``also``: ``puuid, match_id, game_ts``.

    Each document is shuffled once, as one short row. Its players are told apart, and copies folded, where all rows of a
    match have met: folding before the shuffle finds few copies, and spills.
    """
    payload = F.col("json_payload")
    # A text without this key names no players. As the text is looked at twice, Spark makes it before the parse, in
    # compiled code; inside from_json interpreted code would make it.
    may_list = payload.contains('"puuid"') | payload.contains("\\")
    doc = F.from_json(F.when(may_list, payload), INDEX_SCHEMA, JSON_OPTIONS)
    match_id, game_ts = F.col("doc.metadata.matchId"), F.col("doc.info.gameEndTimestamp")
    players = F.col("doc.info.participants.puuid")
    # part of the emitted array, as a filter on a parsed value parses twice
    row = F.array(F.struct(match_id.alias("match_id"), game_ts.alias("game_ts"), players.alias("players")))
    return (
        documents.select(doc.alias("doc"), *also)
        .select(*also, F.inline(F.when(match_id.isNotNull(), row)))
        .repartition("match_id")
        .select(*also, "match_id", "game_ts", F.explode("players").alias("puuid"))
        .where(F.col("puuid").isNotNull())
        .groupBy("puuid", "match_id", *also)
        .agg(F.max("game_ts").alias("game_ts"))
    )


def latest_matches(index: DataFrame, n: int = LATEST_MATCHES) -> DataFrame:
    """The ``n`` newest matches of every player, newest first, ties by match id.

    Spark applies a row-number limit on both sides of the shuffle, so each task sends at most
    ``n`` rows per player, however many matches a player has. Above the size up to which it
    does so, the ranking runs over as many parts of a player's matches as the session has
    shuffle partitions first.
    """
    newest_first = [F.col("game_ts").desc_nulls_last(), F.col("match_id")]

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
        return rows.withColumn("rank", rank).where(F.col("rank") <= n)

    limited_up_to = int(index.sparkSession.conf.get(GROUP_LIMIT_SETTING, "1000"))
    if n > limited_up_to:
        parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64("match_id"), F.lit(parts))
        index = best(index.withColumn("part", part), "puuid", "part").drop("part", "rank")
    return best(index, "puuid").select("puuid", "rank", "match_id", "game_ts")


def may_name(puuid: str) -> Column:
    """Whether a payload can contain this player id, from its text alone.

    A JSON string can spell an id differently only with escapes, so any text with a backslash
    may contain it.
    """
    payload = F.col("json_payload")
    return payload.contains(puuid) | payload.contains("\\")


def named_ids() -> Column:
    """What stands in a payload's text as a value of ``puuid``, without parsing it: all ids that are written without
    escapes."""
    values = F.regexp_extract_all("json_payload", F.lit(PLAYER_ID), F.lit(1))
    return F.transform(values, lambda value: F.trim(value, F.lit('"')))


def may_name_any(puuids: list[str]) -> Column:
    """Whether a payload can contain one of these player ids, from its text alone; see ``may_name``."""
    if len(puuids) <= FEW_PLAYERS:
        return reduce(or_, [may_name(p) for p in puuids], F.lit(False))
    escaped = F.col("json_payload").contains("\\")
    return escaped | F.exists(named_ids(), lambda value: value.isin(puuids))


def documents_naming(documents: DataFrame, puuid: str) -> DataFrame:
    """The documents that may name a player, without parsing them."""
    row = F.array(F.struct("json_payload"))
    return documents.select(F.inline(F.when(may_name(puuid), row)))


def documents_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """One landed document for each match id in ``wanted``: the newest of its copies, ties by text.

    The id is read as ``match_index`` reads it, so whatever the index lists is found.

    ``wanted`` should be a stored table: then Spark knows its size when it decides between
    broadcasting it and shuffling the documents.
    """
    doc = F.from_json("json_payload", INDEX_SCHEMA, JSON_OPTIONS)
    newest = F.struct("game_ts", "json_payload")
    return (
        documents.select("json_payload", doc.alias("doc"))
        .select(
            "json_payload",
            F.col("doc.metadata.matchId").alias("match_id"),
            F.col("doc.info.gameEndTimestamp").alias("game_ts"),
        )
        .join(wanted.select("match_id"), "match_id", "left_semi")
        .groupBy("match_id")
        .agg(F.max_by("json_payload", newest).alias("json_payload"))
        .select("json_payload")
    )
