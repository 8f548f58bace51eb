"""One player's games by the rules of a strict row-wise JSON reader.

The typed parse decides most documents. Those that it is unsure of are read once more as Variant, which keeps what
a typed schema loses: whether a key is absent or null, and of what type a value is. Rules that differ from
``player_games``:

* text after the document drops it;
* entries are looked at in order up to the player's: one that is no object before it drops the document, one after
  it does not;
* a player id that is not a text is nobody's;
* an object or array as match id or champion is shown as maps and lists are, ``{q=1}`` and ``[1, 2]``, the keys as they come.

A document with a key twice or with a number like ``NaN`` has no Variant form; it stays with the typed parse, where the last
key wins and such a number is null.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.documents import JSON_OPTIONS, may_name, with_parsed

MARK = "end of document"
NESTED = r"^[\[{]"  # how the text of an object or array begins


def is_one_value(payload: Column) -> Column:
    """Whether a text is one JSON value and nothing else: as the first of two in an array, the mark is the second."""
    wrapped = F.concat(F.lit("["), payload, F.lit(f',"{MARK}"]'))
    values = F.from_json(wrapped, "array<string>", JSON_OPTIONS)
    return F.coalesce((F.size(values) == 2) & (F.get(values, F.lit(1)) == MARK), F.lit(False))


def _kind(value: str) -> str:
    return f"schema_of_variant({value})"


def _at(value: str, key: str, kind: str = "variant") -> str:
    return f"try_variant_get({value}, '$.{key}', '{kind}')"


def _text(value: str, key: str) -> str:
    """A value as text; an object or array as maps and lists are shown."""
    raw = _at(value, key, "string")
    keys = f"""regexp_replace({raw}, r'"((?:[^"\\\\]|\\\\.)*)":', '$1=')"""
    shown = f"""replace(regexp_replace({keys}, r'"((?:[^"\\\\]|\\\\.)*)"', '$1'), ',', ', ')"""
    kind = _kind(_at(value, key))
    return f"CASE WHEN {kind} LIKE 'OBJECT%' OR {kind} LIKE 'ARRAY%' THEN {shown} ELSE {raw} END"


def _typed(value: str, key: str, kind: str, then: str) -> str:
    """A value of exactly this type, else null."""
    return f"CASE WHEN {_kind(_at(value, key))} = '{kind}' THEN {_at(value, key, then)} END"


def _variant_games() -> Column:
    """The player's game of the document ``variant``, as an array of one row or none."""
    entry = "r.first.entry"
    fields = [
        "r.match_id AS match_id",
        f"{_text(entry, 'championName')} AS champion",
        *(f"{_typed(entry, name, 'BIGINT', 'int')} AS {name}" for name in ("kills", "deaths", "assists")),
        f"{_typed(entry, 'win', 'BOOLEAN', 'boolean')} AS win",
    ]
    metadata = _at("variant", "metadata")
    match_id = f"""CASE WHEN {metadata} IS NULL THEN ''
        WHEN {_kind(metadata)} NOT LIKE 'OBJECT%' THEN NULL
        WHEN {_at(metadata, 'matchId')} IS NULL THEN ''
        WHEN is_variant_null({_at(metadata, 'matchId')}) THEN NULL
        ELSE {_text(metadata, 'matchId')} END"""
    # the entry that decides: the player's, or one that is no object
    is_mine = f"coalesce({_kind(_at('e', 'puuid'))} = 'STRING' AND {_at('e', 'puuid', 'string')} = player, false)"
    entries = f"""transform({_at('variant', 'info.participants', 'array<variant>')},
        e -> named_struct('object', {_kind('e')} LIKE 'OBJECT%', 'mine', {is_mine}, 'entry', e))"""
    first = f"get(filter({entries}, x -> NOT x.object OR x.mine), 0)"
    rows = f"""transform(filter(array(named_struct('match_id', {match_id}, 'first', {first})),
        r -> r.match_id IS NOT NULL AND r.first.mine), r -> struct({', '.join(fields)}))"""
    return F.expr(rows)


def player_games_strict(documents: DataFrame, puuid: str) -> DataFrame:
    """``player_games`` by the strict rules.

    Only documents whose text can name the player are parsed at all. Of these, the Variant form is made for those whose
    entries are missing or partly null, or whose match id or champion looks like an object or array. An id
    that could be the text of a number or truth value makes all of them unsure.
    """
    named = may_name(puuid)
    first = F.get(F.filter("doc.info.participants", lambda p: p["puuid"] == F.lit(puuid)), F.lit(0))
    entries = F.col("doc.info.participants")
    unsure = (
        F.lit(_could_be_no_text(puuid))
        | entries.isNull()
        | F.exists(entries, lambda p: p.isNull())
        | F.coalesce(F.col("match_id").rlike(NESTED), F.lit(True))
        | F.coalesce(F.col("typed.championName").rlike(NESTED), F.lit(False))
    )
    parsed = (
        with_parsed(documents, where=named)
        .withColumn("typed", first)
        .withColumn("whole", F.when(named, is_one_value(F.col("json_payload"))))
        .withColumn("variant", F.when(F.col("whole") & unsure, F.try_parse_json("json_payload")))
        .withColumn("player", F.lit(puuid))
    )
    fields = [F.col(f"typed.{c}").alias(c) for c in ("kills", "deaths", "assists", "win")]
    champion = F.col("typed.championName").alias("champion")
    game = F.array(F.struct(F.col("match_id").alias("match_id"), champion, *fields))
    typed = F.when(F.col("match_id").isNotNull() & F.col("typed").isNotNull(), game)
    games = F.when(F.col("variant").isNotNull(), _variant_games()).otherwise(typed)
    return parsed.select(F.inline(F.when(F.col("whole"), games)))


def _could_be_no_text(puuid: str) -> bool:
    """Whether the id is also how a number, truth value, object or array may be written."""
    try:
        return not isinstance(json.loads(puuid), str)
    except ValueError:
        return False
