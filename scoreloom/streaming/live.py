"""Statistics kept up to date from a stream of landed documents.

Every micro-batch appends its new games to compacted runs, and writes the running sums per champion (the sums of the
batch before plus its own). A batch that is run again after a failure overwrites its own folders from the same
inputs, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.operators.games import every_player_games
from scoreloom.operators.stats import add_sums, game_sums, stats_from_sums
from scoreloom.schemas import PLAYER_GAME_SCHEMA, SUMS_SCHEMA
from scoreloom.sources.files import delete
from scoreloom.sources.landing import stream_documents
from scoreloom.sources.shared import COMPRESSION
from scoreloom.streaming.runs import BATCH, FAN_IN, KEPT_BATCHES, MAX_RUN_ROWS, Runs, last_batch

IDENTITY = ["match_id", "puuid"]
HASH = "identity_hash"
ID_PREFIX = r"^\D*"
MAX_RANGES = 200  # ranges of ids that a batch's history is read by
BYTES_PER_BATCH = 64 << 30


@dataclass(frozen=True)
class LiveStats:
    """A stream's folders below ``base``, which all executors must share."""

    base: str
    fan_in: int = FAN_IN
    most_rows: int = MAX_RUN_ROWS

    def arrived(self, batch_id: int) -> str:
        return f"{self.base}/arrived/{BATCH}={batch_id}"

    def repeated(self, batch_id: int) -> str:
        return f"{self.base}/repeated/{BATCH}={batch_id}"

    def sums_after(self, batch_id: int) -> str:
        return f"{self.base}/sums/{BATCH}={batch_id}"

    @property
    def runs(self) -> Runs:
        """All games counted, sorted by match id, so that a later batch reads only the row groups in its ranges."""
        return Runs(f"{self.base}/games", PLAYER_GAME_SCHEMA, IDENTITY, self.fan_in, self.most_rows)

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    def games(self, spark: SparkSession) -> DataFrame:
        """All games counted so far, with the batch that brought them."""
        return self.runs.read(spark)

    def stats(self, spark: SparkSession) -> DataFrame:
        """Current statistics: the sums after the last batch, read from its folder alone."""
        last = last_batch(spark, f"{self.base}/sums")
        if last is None:
            return stats_from_sums(spark.createDataFrame([], SUMS_SCHEMA), "champion")
        return stats_from_sums(spark.read.schema(SUMS_SCHEMA).parquet(self.sums_after(last)), "champion")

    def changed_stats(self, spark: SparkSession) -> DataFrame:
        """Current statistics of the champions that the last batch brought games of."""
        last = last_batch(spark, f"{self.base}/sums")
        if last is None:
            return self.stats(spark)
        new = self.games(spark).where(F.col(BATCH) == last).select(F.col("champion").alias("played")).distinct()
        return self.stats(spark).join(new, F.col("champion").eqNullSafe(F.col("played")), "left_semi")

    def take_batch(self, documents: DataFrame, batch_id: int) -> None:
        """Count the games of one batch that were not counted before."""
        spark = documents.sparkSession
        _write(every_player_games(documents).select(*PLAYER_GAME_SCHEMA.names), self.arrived(batch_id))
        arrived = spark.read.schema(PLAYER_GAME_SCHEMA).parquet(self.arrived(batch_id))
        counted = self.runs.append(self._fresh(arrived, batch_id), batch_id)

        sums = game_sums(counted, "champion")
        if batch_id > 0:
            before = spark.read.schema(SUMS_SCHEMA).parquet(self.sums_after(batch_id - 1))
            sums = add_sums(before, sums)
        sums.write.mode("overwrite").parquet(self.sums_after(batch_id))
        # The sums after the batch before stay, as this batch may be run again from them, and so do
        # those before, which a reader may have just chosen.
        delete(spark, self.sums_after(batch_id - KEPT_BATCHES))
        delete(spark, self.arrived(batch_id - 1))
        delete(spark, self.repeated(batch_id - 1))

    def _fresh(self, arrived: DataFrame, batch_id: int) -> DataFrame:
        """The games of a stored batch that count: each identity once, and none that earlier batches hold.

        Most games come once, so the games themselves are not shuffled to see it: hashes of the identities are. Games
        whose hash comes again, in the batch or in the history, are compared by the identities.
        """
        spark = arrived.sparkSession
        # A game without a match id has no identity to compare, so each such row counts: its hash is null.
        hashed = arrived.withColumn(HASH, F.when(F.col("match_id") != "", F.xxhash64(*IDENTITY)))
        old = self._in_reach(arrived.where("match_id <> ''"), batch_id).select(F.xxhash64(*IDENTITY).alias(HASH))
        both = hashed.where(F.col(HASH).isNotNull()).select(HASH, F.lit(True).alias("new"))
        both = both.unionByName(old.withColumn("new", F.lit(False)))
        met = both.groupBy(HASH).agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("new"))
        # Stored, so that their size is known: as a rule few or none, which Spark broadcasts.
        hashes, games = f"{self.repeated(batch_id)}/hashes", f"{self.repeated(batch_id)}/games"
        _write(met.where("n > 1 AND new").select(HASH), hashes)
        again = spark.read.schema(f"{HASH} long").parquet(hashes)
        _write(hashed.join(again, HASH, "left_semi").drop(HASH), games)
        repeated = spark.read.schema(PLAYER_GAME_SCHEMA).parquet(games)
        # Copies are folded before the shuffle; of copies that differ the smallest counts, so that a
        # batch that is run again takes the same one.
        values = [c for c in PLAYER_GAME_SCHEMA.names if c not in IDENTITY]
        folded = repeated.groupBy(*IDENTITY).agg(F.min(F.struct(*values)).alias("g")).select(*IDENTITY, "g.*")
        unseen = folded.join(self._seen_before(repeated, batch_id), IDENTITY, "left_anti")
        return hashed.join(again, HASH, "left_anti").drop(HASH).unionByName(unseen)

    def _seen_before(self, arrived: DataFrame, batch_id: int) -> DataFrame:
        """Those identities of ``arrived`` that earlier batches hold.

        The batch is the small side of the semi join, and Spark broadcasts it when its size allows.
        """
        return self._in_reach(arrived, batch_id).join(arrived.select(*IDENTITY), IDENTITY, "left_semi")

    def _in_reach(self, arrived: DataFrame, batch_id: int) -> DataFrame:
        """The identities in earlier batches that may be among those of ``arrived``.

        Ids are a prefix, such as a region, and a number that grows with time. Only ids within the
        batch's range of a prefix are read, as file statistics rule out the rest; that is a small
        share of a long history, however many prefixes a batch holds.
        """
        prefix = F.regexp_extract("match_id", ID_PREFIX, 0)
        ends = arrived.groupBy(prefix.alias("prefix"), F.length("match_id").alias("size")).agg(
            F.min("match_id").alias("low"), F.max("match_id").alias("high")
        )
        ranges = ends.orderBy("low").limit(MAX_RANGES + 1).collect()
        if len(ranges) > MAX_RANGES:  # ids of another form: one range over all of them
            ranges = [arrived.agg(F.min("match_id").alias("low"), F.max("match_id").alias("high")).first()]
        reach = reduce(or_, [F.col("match_id").between(r["low"], r["high"]) for r in ranges], F.lit(False))
        spark = arrived.sparkSession
        counted = self.runs.read(spark, self.runs.after(spark, batch_id - 1))
        return counted.where(F.col("match_id") != "").where(reach).select(*IDENTITY)

    def start(
        self,
        spark: SparkSession,
        landing: str,
        files_per_batch: int | None = None,
        bytes_per_batch: int | None = BYTES_PER_BATCH,
        once: bool = False,
        interval: str = "60 seconds",
    ) -> StreamingQuery:
        """Start counting. With ``once`` the stream ends when all landed files are counted.

        A batch takes up to ``files_per_batch`` files, or else about ``bytes_per_batch``, so a backlog is
        counted in pieces and a failure repeats one of them.
        """
        return start_batches(
            stream_documents(spark, landing, files_per_batch, bytes_per_batch), self.take_batch, self.checkpoint, once, interval
        )


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def start_batches(
    documents: DataFrame,
    take_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool,
    interval: str = "60 seconds",
) -> StreamingQuery:
    """Hand each batch of a stream to a function, every ``interval`` or until nothing is left."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        documents.writeStream.foreachBatch(take_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
