"""Aggregates over all rows, next to every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_one_row(df: DataFrame, name: str, of: DataFrame | None = None, **values: Column) -> DataFrame:
    """Add the struct column ``name`` with aggregates of ``of`` (by default of ``df`` itself).

    The aggregates are one single-row subquery: no join and no window over all rows. It is
    placed in one column, so that expressions using it many times do not repeat it.
    """
    aggregates = F.struct(*[value.alias(key) for key, value in values.items()])
    source = df if of is None else of
    return df.select("*", source.agg(aggregates.alias(name)).scalar().alias(name))
