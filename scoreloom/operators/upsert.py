"""Upsert of statistics into a maintained table.

Matched rows take the source's values, unmatched source rows are added, and unmatched target
rows stay. Rows are never deleted, so a table fed with moving windows mixes them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish
from scoreloom.sources.tables import (
    VERSIONED_PROVIDERS,
    finish_overwrite,
    overwrite_table,
    table_provider,
)


class DuplicateSourceKey(ValueError):
    """Two source rows match the same target row."""


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _same(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(and_, tests)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str] = "champion",
    null_safe: bool = False,
) -> DataFrame:
    """``target`` after the upsert of ``source``, as a plan.

    With plain equality a null key matches nothing: null rows of both sides are kept, and
    repeating the upsert adds the source's null row again. Those target rows skip the join,
    so they never gather in one task. ``null_safe`` makes null match null.
    """
    keys = _names(key)
    rows = source.select(*target.columns)
    if null_safe:
        same = _same("t", "s", keys, null_safe)
        kept = target.alias("t").join(rows.select(*keys).alias("s"), same, "left_anti")
        return kept.unionByName(rows)
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    kept = target.where(~any_null).join(rows.where(~any_null).select(*keys), keys, "left_anti")
    return kept.unionByName(target.where(any_null)).unionByName(rows)


def check_source(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str] = "champion",
    null_safe: bool = False,
) -> None:
    """Raise when two source rows would match one target row."""
    keys = _names(key)
    repeated = source.groupBy(*keys).count().where("count > 1").select(*keys).alias("s")
    same = _same("s", "t", keys, null_safe)
    found = repeated.join(target.select(*keys).alias("t"), same, "left_semi").take(1)
    if found:
        raise DuplicateSourceKey(f"more than one source row for {found[0].asDict()}")


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str | Sequence[str] = "champion",
    null_safe: bool = False,
    fmt: str | None = None,
) -> int | None:
    """Upsert into a catalog table, creating it from the source in ``fmt`` (Parquet if not given) when it does not exist.

    Tables that take MERGE are merged in place. Others are written to a new folder and the
    table is then moved to it, so the files being read are never overwritten. Returns the
    rows of the new version, or None after a MERGE. The source is computed once: an update
    reads it several times, so it is published first.
    """
    if not finish_overwrite(spark, table):
        return overwrite_table(source, table, fmt)
    source = publish(source, "upsert-source")
    target = spark.table(table)
    if table_provider(spark, table) in VERSIONED_PROVIDERS:
        (
            source.alias("s")
            .mergeInto(table, _same(table, "s", _names(key), null_safe))
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return None
    check_source(target, source, key, null_safe)
    return overwrite_table(upsert(target, source, key, null_safe), table)
