"""Match documents and games from the benchmark tables.

Every ``lineitem`` row is one match between two players: the supplier of the row, who plays
the character named by the part, and a rival, who plays the part's brand. Each document comes
from its own row, so nothing is grouped to build it, however often a key repeats. The two
players are sometimes the same one, and the rival is listed first on even line numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish
from scoreloom.operators.feed import champion_feed, champion_metrics
from scoreloom.operators.stats import champion_stats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match: ids, end time, and the two participants in document order."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # No hint: Spark broadcasts the parts when they are small enough, and otherwise splits a
    # part that holds a large share of the lines.
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    game_end = _epoch_ms("l_shipdate")
    match_id = F.concat(
        F.lit("M"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", game_end),
    )
    own, rival = _own_entry(), _rival_entry()
    rival_first = F.col("l_linenumber") % 2 == 0
    return joined.select(
        "l_orderkey",
        "l_returnflag",
        "l_linestatus",
        match_id.alias("match_id"),
        game_end.alias("game_end"),
        F.when(rival_first, F.array(rival, own)).otherwise(F.array(own, rival)).alias("entries"),
    )


def _own_wins() -> Column:
    luck = F.pmod(
        F.col("l_orderkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 7, F.lit(100)
    )
    skill = F.pmod(F.length("p_name") * 5 + F.ascii(F.right("p_name", F.lit(1))), F.lit(14))
    return luck < skill + 43


def _own_entry() -> Column:
    return F.struct(
        F.concat(F.lit("P"), F.col("l_suppkey")).alias("puuid"),
        F.col("p_name").alias("championName"),
        F.col("l_quantity").cast("int").alias("kills"),
        F.col("l_linenumber").alias("deaths"),
        F.round(F.col("l_tax") * 100).cast("int").alias("assists"),
        _own_wins().alias("win"),
    )


def _rival_entry() -> Column:
    return F.struct(
        F.concat(F.lit("P"), F.col("l_partkey") % 100).alias("puuid"),
        F.col("p_brand").alias("championName"),
        F.col("l_linenumber").alias("kills"),
        F.col("l_quantity").cast("int").alias("deaths"),
        F.round(F.col("l_discount") * 100).cast("int").alias("assists"),
        (~_own_wins()).alias("win"),
    )


def _epoch_ms(column: str) -> Column:
    """Milliseconds since 1970 of a time without zone, whatever the session's zone is."""
    moment = F.col(column)
    second = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return (F.unix_date(moment.cast("date")).cast("long") * 86400 + second) * 1000


def document_text() -> Column:
    return F.to_json(
        F.struct(
            F.struct(F.col("match_id").alias("matchId")).alias("metadata"),
            F.struct(
                F.col("game_end").alias("gameEndTimestamp"),
                F.col("entries").alias("participants"),
            ).alias("info"),
        )
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches as raw documents."""
    return matches(spark, sf_dir).select(document_text().alias("json_payload"))


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, with the documents of some orders damaged in the ways that occur.

    Cut off, replaced by an error answer, without participants, or empty; with absent, null or
    unusable ids and entries; with ids and values of other types; with an id twice; and with
    participants that come again with other values, of whom the first counts.
    """
    # The text is a column of its own, made once: inside the branches Spark would make it anew in each of them.
    texts = matches(spark, sf_dir).select("l_orderkey", "match_id", document_text().alias("text"))
    text = F.col("text")
    kind = F.col("l_orderkey") % 50
    quote = F.lit('"')
    metadata = F.concat(F.lit('"metadata":{"matchId":"'), F.col("match_id"), F.lit('"}'))
    id_text = F.concat(quote, F.col("match_id"), quote)
    entries = F.substring(
        text,
        F.instr(text, '"participants":[') + len('"participants":['),
        F.length(text) - F.instr(text, '"participants":[') - len('"participants":[') - 2,
    )

    def with_entries(value: Column) -> Column:
        return F.concat(F.lit("{"), metadata, F.lit(',"info":{"participants":['), value, F.lit("]}}"))

    again = F.replace(entries, F.lit('"kills":'), F.lit('"kills":9'))
    many = F.concat_ws(",", entries, *[again] * 4)
    error = '{"status":{"message":"Rate limit exceeded","status_code":429}}'
    nobody = F.concat(
        F.lit('{"metadata":{"matchId":"'), F.col("match_id"), F.lit('"},"info":{"participants":null}}')
    )
    payload = (
        F.when(kind == 0, F.substring(text, F.lit(1), F.length(text) - 5))
        .when(kind == 1, F.lit(error))
        .when(kind == 2, nobody)
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.replace(text, F.concat(metadata, F.lit(",")), F.lit("")))
        .when(kind == 5, F.replace(text, metadata, F.lit('"metadata":{}')))
        .when(kind == 6, F.replace(text, metadata, F.lit('"metadata":null')))
        .when(kind == 7, F.replace(text, metadata, F.lit('"metadata":"s"')))
        .when(kind == 8, F.replace(text, id_text, F.lit("null")))
        .when(kind == 9, F.replace(text, id_text, F.col("l_orderkey").cast("string")))
        .when(kind == 10, F.replace(text, id_text, F.concat(F.lit('"D1","matchId":'), id_text)))
        .when(kind == 11, F.replace(text, id_text, F.concat(F.lit('{"q":'), id_text, F.lit("}"))))
        .when(kind == 12, with_entries(F.lit("null")))
        .when(kind == 13, with_entries(F.concat(F.lit("null,"), entries)))
        .when(kind == 14, with_entries(F.concat(F.lit("5,"), entries)))
        .when(kind == 15, F.regexp_replace(text, '"kills":(\\d+)', '"kills":"$1"'))
        .when(kind == 16, F.regexp_replace(text, '"win":(true|false)', '"win":"$1"'))
        .when(kind == 17, F.replace(text, F.lit('"assists":'), F.lit('"assists":1.5,"none":')))
        .when(kind == 18, with_entries(many))
        .otherwise(text)
    )
    return texts.select(payload.alias("json_payload"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The participant rows of all matches, as the game table holds them.

    Equal to extracting them from the documents, for queries that start at the game table.
    """
    return matches(spark, sf_dir).select(
        "match_id", "l_returnflag", "l_linestatus", F.inline("entries")
    ).withColumnRenamed("championName", "champion")


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return champion_stats(games(spark, sf_dir))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed, published: panels read it several times, the games are read once."""
    return publish(champion_feed(stats(spark, sf_dir)), "feed")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return champion_metrics(feed(spark, sf_dir))
