"""A table kept in hash buckets of its key, of which a change rewrites only those that it touches.

Rows lie in ``<base>/rows/version=<v>/bucket=<b>``. A manifest names, for each bucket, the version that holds it. A change
writes the touched buckets as a new version and then a new manifest; until that is complete, readers and later
writers see the table as it was. One writer at a time, as with any overwrite.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.upsert import check_source, upsert
from scoreloom.sources.files import children, delete, is_complete
from scoreloom.sources.shared import publish

BUCKET = "bucket"
MANIFEST_SCHEMA = "bucket int, version string"
KEPT_MANIFESTS = 3  # the last one, and those that a reader may have just chosen

Combine = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class BucketedTable:
    """A table below ``base``, which all executors must share.

    ``buckets`` is fixed when the table is made; it should let a bucket fit a task (its rows are written by
    one). ``null_safe`` says that a null key is a key like others. Otherwise it equals nothing, and rows that have
    one are spread by all their columns.
    """

    base: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int
    null_safe: bool = False

    def bucket_of(self) -> Column:
        by_key = F.xxhash64(*self.key)
        if not self.null_safe:
            any_null = reduce(or_, [F.col(k).isNull() for k in self.key])
            by_key = F.when(any_null, F.xxhash64(*self.schema.names)).otherwise(by_key)
        return F.pmod(by_key, F.lit(self.buckets)).cast("int")

    # --- reading ----------------------------------------------------------------------------

    def manifest_number(self, spark: SparkSession) -> int:
        """The number of the last complete manifest, 0 for a table without rows and history."""
        return max(self._manifests(spark), default=0)

    def places(self, spark: SparkSession) -> dict[int, str]:
        """The version that holds each bucket that has rows."""
        return self._places(spark, self.manifest_number(spark))

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or those of its buckets, and nothing else is listed or opened."""
        return self._rows(spark, self.places(spark), buckets).select(*self.schema.names)

    def _places(self, spark: SparkSession, number: int) -> dict[int, str]:
        if not number:
            return {}
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(self._manifest(number)).collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _rows(self, spark: SparkSession, places: dict[int, str], buckets: Sequence[int] | None) -> DataFrame:
        chosen = places if buckets is None else {b: places[b] for b in buckets if b in places}
        shape = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not chosen:
            return spark.createDataFrame([], shape)
        folders = [f"{self.base}/rows/version={v}/{BUCKET}={b}" for b, v in sorted(chosen.items())]
        return spark.read.schema(shape).option("basePath", f"{self.base}/rows").parquet(*folders)

    # --- writing ----------------------------------------------------------------------------

    def replace(self, rows: DataFrame) -> int:
        """The table is ``rows`` from now on; returns the number of buckets that have some."""
        spark = rows.sparkSession
        number = self.manifest_number(spark)
        version, found = self._write(rows.select(*self.schema.names).withColumn(BUCKET, self.bucket_of()))
        self._commit(spark, number + 1, dict.fromkeys(found, version))
        return len(found)

    def change(self, source: DataFrame, combine: Combine) -> int:
        """Rewrite the buckets that hold keys of ``source``; returns how many.

        ``combine`` takes the rows of those buckets and the source, and returns their new rows, all of keys
        that one of the two has. The source is computed once. The driver holds the numbers of buckets only.
        """
        spark = source.sparkSession
        number = self.manifest_number(spark)
        places = self._places(spark, number)
        stored = publish(source.withColumn(BUCKET, self.bucket_of()), "bucketed-source")
        touched = sorted(r[0] for r in stored.select(BUCKET).distinct().collect())
        if not touched:
            return 0
        before = self._rows(spark, places, touched).select(*self.schema.names)
        after = combine(before, stored.drop(BUCKET)).select(*self.schema.names)
        version, found = self._write(after.withColumn(BUCKET, self.bucket_of()))
        if not set(found) <= set(touched):
            raise ValueError("the new rows have keys that neither the buckets nor the source had")
        kept = {b: v for b, v in places.items() if b not in set(touched)}
        self._commit(spark, number + 1, kept | dict.fromkeys(found, version))
        return len(touched)

    def upsert(self, source: DataFrame) -> int:
        """Replace rows of equal keys, add the others, keep the rest; returns the number of buckets rewritten.

        Raises when two source rows match one row of the table.
        """

        def combine(before: DataFrame, rows: DataFrame) -> DataFrame:
            check_source(before, rows, self.key, self.null_safe)
            return upsert(before, rows, self.key, self.null_safe)

        return self.change(source.select(*self.schema.names), combine)

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Write rows as a new version; its id and the buckets in it, as found among the files."""
        version = uuid.uuid4().hex
        folder = f"{self.base}/rows/version={version}"
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        names = children(rows.sparkSession, folder)
        return version, [int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")]

    def _manifest(self, number: int) -> str:
        return f"{self.base}/manifests/{number}"

    def _manifests(self, spark: SparkSession) -> list[int]:
        """Numbers of complete manifests: their writer's last act is the mark of success."""
        numbers = [int(n) for n in children(spark, f"{self.base}/manifests") if n.isdigit()]
        last_first = sorted(numbers, reverse=True)
        return [n for n in last_first if is_complete(spark, self._manifest(n))]

    def _commit(self, spark: SparkSession, number: int, places: dict[int, str]) -> None:
        rows = spark.createDataFrame(sorted(places.items()), MANIFEST_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(self._manifest(number))

    # --- clean-up ---------------------------------------------------------------------------

    def remove_old_versions(self, spark: SparkSession, keep: int = KEPT_MANIFESTS) -> int:
        """Delete buckets that none of the last ``keep`` manifests names, and older manifests; returns the buckets deleted.

        To be called when no change is being written.
        """
        numbers = sorted(self._manifests(spark))
        named = {(v, b) for n in numbers[-keep:] for b, v in self._places(spark, n).items()}
        gone = 0
        for child in children(spark, f"{self.base}/rows"):
            if not (match := re.fullmatch(r"version=([0-9a-f]{32})", child)):
                continue
            folder, version = f"{self.base}/rows/{child}", match[1]
            inside = [n for n in children(spark, folder) if n.startswith(f"{BUCKET}=")]
            old = [n for n in inside if (version, int(n.removeprefix(f"{BUCKET}="))) not in named]
            for name in old if len(old) < len(inside) else [""]:
                delete(spark, f"{folder}/{name}".rstrip("/"))
            gone += len(old)
        for number in numbers[:-keep]:
            delete(spark, self._manifest(number))
        return gone
