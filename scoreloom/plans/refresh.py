"""Panels that are kept up to date from changed champions only.

The state is one bucketed table: the feed's rows, and how many champions have each rate and each volume. Extremes, median,
moments, histogram and tiers follow from these counts, of which there are few: rates have one decimal, and distinct
volumes grow with the square root of the games. A refresh takes the changed champions' old values out of the counts and puts
their new ones in, in one change of the table, so that a refresh that is run again changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.fixed_values import DEFAULT_TIER, SMALL_FEED_ROWS
from scoreloom.functions.overall import with_one_row
from scoreloom.functions.tiers import tier_of
from scoreloom.schemas import FEED_SCHEMA
from scoreloom.sources.buckets import BucketedTable

CHAMPION, BY_RATE, BY_VOLUME = "champion", "rate", "volume"
STATE_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("champion", T.StringType()),
        T.StructField("win_rate_pct", T.DoubleType()),
        T.StructField("matches_played", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)
WEIGHT = "n"


def _key(column: str) -> Column:
    """A text that is never null and differs for null and every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def _feed_rows(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.lit(CHAMPION).alias("kind"), _key("champion").alias("key"), *FEED_SCHEMA.names, F.lit(1).cast("long").alias("n")
    )


def _counts(rows: DataFrame, kind: str, column: str) -> DataFrame:
    """Champions by one value of feed rows, each counted ``n`` times."""
    added = rows.groupBy(column).agg(F.sum("n").alias("n"))
    values = [
        F.col(c) if c == column else F.lit(None).cast(STATE_SCHEMA[c].dataType).alias(c) for c in FEED_SCHEMA.names
    ]
    return added.select(F.lit(kind).alias("kind"), _key(column).alias("key"), *values, "n")


@dataclass(frozen=True)
class PanelState:
    """The state below ``base``, which all executors must share."""

    base: str
    buckets: int = 16

    @property
    def state(self) -> BucketedTable:
        return BucketedTable(f"{self.base}/panels", STATE_SCHEMA, ("kind", "key"), self.buckets)

    def refresh(self, changed: DataFrame) -> None:
        """Bring the feed rows of changed champions in, one row for each of them.

        What is read is the buckets of those champions and of the values that they had and have.
        """
        spark = changed.sparkSession
        new = _feed_rows(changed)
        touched = [r[0] for r in new.select(self.state.bucket_of()).distinct().collect()]
        stored = self.state.read(spark, touched).where(F.col("kind") == CHAMPION)
        old = stored.join(new.select("key"), "key", "left_semi").select(*STATE_SCHEMA.names)
        moved = old.withColumn("n", -F.col("n")).unionByName(new)
        counts = _counts(moved, BY_RATE, "win_rate_pct").unionByName(_counts(moved, BY_VOLUME, "matches_played"))

        def together(before: DataFrame, source: DataFrame) -> DataFrame:
            is_row = F.col("kind") == CHAMPION
            rows = source.where(is_row)
            kept = before.where(is_row).join(rows.select("key"), "key", "left_anti").select(*STATE_SCHEMA.names)
            others = [c for c in STATE_SCHEMA.names if c != "n"]
            added = before.where(~is_row).unionByName(source.where(~is_row)).groupBy(*others).agg(F.sum("n").alias("n"))
            return kept.unionByName(rows).unionByName(added.where("n <> 0"))

        self.state.change(new.unionByName(counts.where("n <> 0")), together)
        self.state.remove_old_versions(spark)

    def feed(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, CHAMPION).select(*FEED_SCHEMA.names)

    def rates(self, spark: SparkSession) -> DataFrame:
        """``win_rate_pct``, its ``tier`` and the number ``n`` of champions, for the panels that take weights."""
        rows = with_one_row(self._rows(spark, BY_RATE), "over_all", champions=F.sum("n"))
        small = F.col("over_all.champions") < SMALL_FEED_ROWS
        tier = F.when(small, DEFAULT_TIER).otherwise(tier_of(F.col("win_rate_pct")))
        return rows.select("win_rate_pct", tier.alias("tier"), "n")

    def volumes(self, spark: SparkSession) -> DataFrame:
        """``matches_played`` and the number ``n`` of champions."""
        return self._rows(spark, BY_VOLUME).select("matches_played", "n")

    def _rows(self, spark: SparkSession, kind: str) -> DataFrame:
        return self.state.read(spark).where(F.col("kind") == kind)
