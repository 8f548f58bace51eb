"""Every player's latest matches, kept up to date from a stream of landed documents.

The state is a bucketed table of at most ``n`` matches a player. A batch looks at the buckets of its players only. Late matches
find their place, and copies of a match count once with the newest time, as in ``match_index``: what was
pushed out by ``n`` newer matches can only come back with a newer time of its own. Running a batch again
changes nothing, so no batch needs to be remembered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from scoreloom.fixed_values import LATEST_MATCHES
from scoreloom.operators.documents import latest_matches, match_index
from scoreloom.sources.buckets import BucketedTable
from scoreloom.sources.landing import stream_documents
from scoreloom.streaming.live import BYTES_PER_BATCH, start_batches

STATE_SCHEMA = T.StructType(
    [
        T.StructField("puuid", T.StringType()),
        T.StructField("match_id", T.StringType()),
        T.StructField("game_ts", T.LongType()),
    ]
)


@dataclass(frozen=True)
class LatestMatches:
    """A stream's folders below ``base``, which all executors must share.

    ``buckets`` should let the state of a bucket's players fit a task.
    """

    base: str
    n: int = LATEST_MATCHES
    buckets: int = 64

    @property
    def state(self) -> BucketedTable:
        return BucketedTable(f"{self.base}/latest", STATE_SCHEMA, ("puuid",), self.buckets, null_safe=True)

    def latest(self, spark: SparkSession) -> DataFrame:
        """``puuid, rank, match_id, game_ts``, as ``latest_matches`` gives them for all documents so far."""
        return latest_matches(self.state.read(spark), self.n)

    def take_batch(self, documents: DataFrame, batch_id: int) -> None:
        """Bring one batch's matches into the state."""

        def newest(before: DataFrame, new: DataFrame) -> DataFrame:
            together = before.unionByName(new).groupBy("puuid", "match_id").agg(F.max("game_ts").alias("game_ts"))
            return latest_matches(together, self.n)

        new = latest_matches(match_index(documents), self.n).select(*STATE_SCHEMA.names)
        self.state.change(new, newest)
        self.state.remove_old_versions(documents.sparkSession)

    def start(
        self,
        spark: SparkSession,
        landing: str,
        files_per_batch: int | None = None,
        bytes_per_batch: int | None = BYTES_PER_BATCH,
        once: bool = False,
        interval: str = "60 seconds",
    ) -> StreamingQuery:
        """Follow the landing folder; see ``LiveStats.start``."""
        documents = stream_documents(spark, landing, files_per_batch, bytes_per_batch)
        return start_batches(documents, self.take_batch, f"{self.base}/checkpoint", once, interval)
