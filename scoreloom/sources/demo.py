"""The static feed shown when no statistics can be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.fixed_values import DEMO_ROWS
from scoreloom.schemas import FEED_SCHEMA


def demo_feed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEMO_ROWS, FEED_SCHEMA)
