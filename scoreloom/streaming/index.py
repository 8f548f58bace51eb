"""An index from players to the landed files that hold their matches, kept up with each landing.

The stream's checkpoint knows which files were read, so an update parses new files only. A look-up reads the row groups
of one player, and the documents then come from the files that it names, whatever else has landed.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.fixed_values import LATEST_MATCHES
from scoreloom.operators.documents import (
    documents_naming,
    documents_of,
    latest_matches,
    match_index,
)
from scoreloom.sources.landing import FILE, read_documents, stream_documents
from scoreloom.sources.shared import publish
from scoreloom.streaming.live import BYTES_PER_BATCH, start_batches
from scoreloom.streaming.runs import Runs

PLACES_SCHEMA = T.StructType(
    [
        T.StructField("puuid", T.StringType()),
        T.StructField("match_id", T.StringType()),
        T.StructField("game_ts", T.LongType()),
        T.StructField(FILE, T.StringType()),
    ]
)


@dataclass(frozen=True)
class LandingIndex:
    """The index below ``base``, which all executors must share, of the folder ``landing``.

    Landed files do not change and are not removed while the index names them.
    """

    base: str
    landing: str

    @property
    def places(self) -> Runs:
        """One row per player, match and file: the time that the file gives for the match."""
        return Runs(f"{self.base}/places", PLACES_SCHEMA, ("puuid", "match_id"))

    def update(
        self, spark: SparkSession, files_per_batch: int | None = None, bytes_per_batch: int | None = BYTES_PER_BATCH
    ) -> None:
        """Index what has landed since the last update."""
        documents = stream_documents(spark, self.landing, files_per_batch, bytes_per_batch, with_file=True)
        start_batches(documents, self.take_batch, f"{self.base}/checkpoint", once=True).awaitTermination()

    def take_batch(self, documents: DataFrame, batch_id: int) -> None:
        self.places.append(match_index(documents, FILE), batch_id)

    def latest(self, spark: SparkSession, puuid: str, n: int = LATEST_MATCHES) -> tuple[DataFrame, list[str]]:
        """A player's newest matches, as ``latest_matches`` gives them, and the files with their newest copies.

        The driver holds the names of those files: n of them, and more only where a match landed
        several times with the same time.
        """
        mine = self.places.read(spark).where(F.col("puuid") == F.lit(puuid)).drop("batch_id")
        newest = mine.groupBy("puuid", "match_id").agg(F.max("game_ts").alias("game_ts"))
        wanted = publish(latest_matches(newest, n), "latest")
        same = wanted.select(F.col("match_id").alias("wanted_id"), F.col("game_ts").alias("wanted_ts"))
        found = mine.join(same, (F.col("match_id") == F.col("wanted_id")) & F.col("game_ts").eqNullSafe(F.col("wanted_ts")))
        return wanted, sorted(r[0] for r in found.select(FILE).distinct().collect())

    def latest_documents(self, spark: SparkSession, puuid: str, n: int = LATEST_MATCHES) -> DataFrame:
        """One document for each of a player's newest matches, from the files that hold them."""
        wanted, files = self.latest(spark, puuid, n)
        if not files:
            return read_documents(spark, self.landing).limit(0)
        # file names come as they stand in an address
        landed = read_documents(spark, [unquote(f) for f in files])
        return documents_of(documents_naming(landed, puuid), wanted)
