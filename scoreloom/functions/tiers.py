"""Win-rate tiers and their attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.fixed_values import (
    DEFAULT_TIER,
    TIER_BAR_COLORS,
    TIER_BAR_DEFAULT,
    TIER_MAP_COLORS,
    TIER_MAP_DEFAULT,
    TIER_RANGES,
    TIERS_BEST_FIRST,
    TIERS_WORST_FIRST,
)


def tier_of(rate: Column) -> Column:
    """The tier whose right-closed range holds ``rate``.

    A rate of exactly 0, outside 0 to 100, or unknown is in no range and gets the default.
    """
    tier = F.lit(None).cast("string")
    for name, low, high in TIER_RANGES:
        tier = F.when((rate > low) & (rate <= high), name).otherwise(tier)
    return F.coalesce(tier, F.lit(DEFAULT_TIER))


def lookup(key: Column, values: dict[str, str], default: str) -> Column:
    """The value of ``key`` in a small fixed mapping, or the default."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def tier_map_color(tier: Column) -> Column:
    return lookup(tier, TIER_MAP_COLORS, TIER_MAP_DEFAULT)


def tier_bar_color(tier: Column) -> Column:
    return lookup(tier, TIER_BAR_COLORS, TIER_BAR_DEFAULT)


def tier_table(spark: SparkSession, worst_first: bool = False) -> DataFrame:
    """The four tiers with their rank, starting at 0."""
    order = TIERS_WORST_FIRST if worst_first else TIERS_BEST_FIRST
    rows = [(name, rank) for rank, name in enumerate(order)]
    return spark.createDataFrame(rows, "tier string, tier_rank int")
