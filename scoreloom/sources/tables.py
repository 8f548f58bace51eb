"""Catalog tables: crash-safe overwrite, scan, counted writes, and versions beside a table's own folder.

A table's rows lie in version folders named ``<table's folder>-v<id>``. Every overwrite writes a new one, points the
catalog at it, and leaves the old one for ``remove_old_versions``. A write that fails changes nothing that a
reader sees.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scoreloom.sources.files import children, delete

VERSION = re.compile(r"-v[0-9a-f]{32}$")
NEXT = "__next_"  # between a table's name and the id of the version that is to replace it
DEFAULT_FORMAT = "parquet"
# Providers whose own overwrite is one step and whose tables take row-level MERGE.
VERSIONED_PROVIDERS = ("delta", "iceberg")


def overwrite_table(
    df: DataFrame, table: str, fmt: str | None = None, partition_by: Sequence[str] | None = None
) -> int:
    """Replace the rows of ``table`` by ``df``, creating it where needed; returns the rows written.

    ``df`` may read the table itself. ``fmt`` and ``partition_by`` default to what the table has (Parquet and none
    for a new one); any of format, columns and partitioning may change.

    The rows go to a new version folder first. With columns, format and layout as before, the catalog is
    pointed at it by one ``SET LOCATION``. Otherwise the new version becomes a table of its own, which takes the
    name: should the run end between dropping the name and taking it, the next ``overwrite_table`` or
    ``scan_table`` finishes that. Tables made here are external, so no catalog command deletes rows; a table
    that was made elsewhere as a managed one is dropped with its files only when its successor is registered.
    Buckets are not kept.
    """
    spark = df.sparkSession
    exists = finish_overwrite(spark, table)
    provider = table_provider(spark, table) if exists else ""
    fmt = (fmt or provider or DEFAULT_FORMAT).lower()
    if fmt in VERSIONED_PROVIDERS:
        counted, seen = _counted(df, table)
        counted.writeTo(table).using(fmt).createOrReplace()
        return _rows(seen, spark, table)
    layout = partitions_of(spark, table) if exists else []
    partition_by = layout if partition_by is None else list(partition_by)

    version = uuid.uuid4().hex
    base = VERSION.sub("", table_location(spark, table)) if exists else default_location(spark, table)
    path = f"{base}-v{version}"
    counted, seen = _counted(df, table)
    counted.write.format(fmt).partitionBy(*partition_by).save(path)

    written = _with_partitions_last(df, partition_by)
    alike = exists and fmt == provider and not layout and not partition_by and not _bucketed(spark, table)
    if alike and _columns_of(spark, table) == written.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        successor = f"{table}{NEXT}{version}"
        _register(spark, successor, written, fmt, path, partition_by)
        _take_name(spark, successor, table)
    spark.catalog.refreshTable(table)
    return _rows(seen, spark, table)


def _counted(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows of {table}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _rows(seen: Observation, spark: SparkSession, table: str) -> int:
    """The rows counted by the write itself; an optimised plan can lose the counter, then by a second look."""
    n = seen.get.get("n")
    return spark.table(table).count() if n is None else n


def _with_partitions_last(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in partition_by], *partition_by) if partition_by else df


def _register(
    spark: SparkSession, table: str, rows: DataFrame, fmt: str, path: str, partition_by: Sequence[str]
) -> None:
    layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    columns = rows.schema.toDDL()
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} {layout} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def _take_name(spark: SparkSession, successor: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {successor} RENAME TO {table}")


def finish_overwrite(spark: SparkSession, table: str) -> bool:
    """Give the name to a successor that a broken-off overwrite has left without it; whether the table exists."""
    if spark.catalog.tableExists(table):
        return True
    for successor in _successors(spark, table):
        try:
            spark.sql(f"ALTER TABLE {successor} RENAME TO {table}")
        except AnalysisException:  # somebody else has finished it meanwhile
            pass
        return spark.catalog.tableExists(table)
    return False


def _successors(spark: SparkSession, table: str) -> list[str]:
    """Registered tables that were to replace ``table``."""
    *place, name = table.split(".")
    bare = name.strip("`").lower()
    shown = spark.sql(f"SHOW TABLES {'IN ' + '.'.join(place) if place else ''} LIKE '{bare}{NEXT}*'")
    names = [r["tableName"] for r in shown.select("tableName").collect()]
    own = re.compile(re.escape(bare + NEXT) + "[0-9a-f]{32}$")
    return [".".join([*place, n]) for n in sorted(names) if own.match(n)]


def remove_old_versions(spark: SparkSession, table: str) -> int:
    """Delete the folders of a table's earlier versions, and what a broken-off overwrite has left; returns how many
    folders.

    To be called when nobody reads or writes them, such as before the next run. Only the table's first
    folder and folders that ``overwrite_table`` named are touched.
    """
    finish_overwrite(spark, table)
    for successor in _successors(spark, table):
        spark.sql(f"DROP TABLE {successor}")
    current = table_location(spark, table)
    base = VERSION.sub("", current)
    storage, first = base.rsplit("/", 1)
    own = [n for n in children(spark, storage) if VERSION.sub("", n) == first]
    return sum(delete(spark, f"{storage}/{n}") for n in own if n != current.rsplit("/", 1)[1])


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    if finish_overwrite(spark, table):
        remove_old_versions(spark, table)
        place = table_location(spark, table)
        spark.sql(f"DROP TABLE {table}")
        delete(spark, place)


def _columns_of(spark: SparkSession, table: str) -> str:
    return spark.table(table).schema.simpleString()


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    finish_overwrite(spark, table)
    return spark.table(table)


def _described(spark: SparkSession, table: str, field: str) -> str:
    rows = (
        spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
        .where(F.col("col_name") == field)
        .select("data_type")
        .take(1)
    )
    return rows[0][0] if rows else ""


def table_provider(spark: SparkSession, table: str) -> str:
    """The storage provider of a table, in lower case, or an empty string."""
    return _described(spark, table, "Provider").lower()


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Location").rstrip("/")


def default_location(spark: SparkSession, table: str) -> str:
    """Where a table of this name belongs in its database's storage."""
    *place, name = [part.strip("`") for part in table.split(".")]
    database = spark.catalog.getDatabase(".".join(place) or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name.lower()}"


def partitions_of(spark: SparkSession, table: str) -> list[str]:
    """The partition columns of a table."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _bucketed(spark: SparkSession, table: str) -> bool:
    return _described(spark, table, "Num Buckets") not in ("", "0")
