"""Positions of all rows in one total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish

_PART, _PLACE = "__part", "__place"
_PLACE_BITS = 33  # of monotonically_increasing_id: partition above, place in the partition below


def _ordered(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """``df`` sorted in parallel and stored with each row's partition and its place there."""
    at = F.monotonically_increasing_id()
    return publish(
        df.orderBy(*order).select(
            "*",
            F.shiftright(at, _PLACE_BITS).cast("int").alias(_PART),
            at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(_PLACE),
        ),
        "ordered",
    )


def _rows_before(stored: DataFrame) -> DataFrame:
    """For each partition of a stored order, the rows of the partitions before, as ``__start``.

    One row per partition, as many as the session has shuffle partitions at most.
    """
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(_PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )


def numbered(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """Number all rows from 0 in ``order``, which should be total for the result to be fixed.

    The rows are sorted in parallel and stored with partition and place as columns, whatever
    files the writer makes of them. A row's position is its place in its partition plus the
    rows in the partitions before; only one count per partition passes through one task.
    """
    stored = _ordered(df, order)
    return (
        stored.join(_rows_before(stored), _PART)
        .withColumn(name, F.col("__start") + F.col(_PLACE))
        .drop(_PART, _PLACE, "__start")
    )


def with_position(
    df: DataFrame, rate: str, tie: str, descending: bool = False, name: str = "pos"
) -> DataFrame:
    """Number the rows from 0 in the order of ``rate``, unknown rates last, ties by ``tie``.

    The sort splits at rate and tie, so a rate that many rows share is spread, too.
    """
    by_rate = F.desc_nulls_last(rate) if descending else F.asc_nulls_last(rate)
    return numbered(df, [by_rate, F.col(tie)], name)
