"""Rows that batches append, in sorted runs that are compacted by size.

Every batch writes its rows as a run and then the list of runs that hold all rows. When several runs of one size have
come together, they become one. So the rows of n batches lie in a number of runs that grows with log n, until
runs have reached the largest size. A batch that is run again after a failure starts from the list after the batch
before and overwrites its own folders, so nothing is appended twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.sources.files import children, delete, is_complete
from scoreloom.sources.shared import COMPRESSION

BATCH = "batch_id"
FAN_IN = 4  # runs of one size that become one
MAX_RUN_ROWS = 1 << 30  # of a run that others are merged into
KEPT_BATCHES = 3  # whose lists stay for readers
ROW_GROUP_BYTES = 16 << 20
LIST_SCHEMA = "first long, last long, rows long"


@dataclass(frozen=True)
class Run:
    """The rows that the batches ``first`` to ``last`` brought."""

    first: int
    last: int
    rows: int

    @property
    def batches(self) -> int:
        return self.last - self.first + 1


def compacted(runs: list[Run], fan_in: int = FAN_IN, most_rows: int = MAX_RUN_ROWS) -> list[Run]:
    """``runs`` after the last ones of equal size, in batches, have become one, and so on upwards.

    What it does follows from the runs alone, so a batch that is run again does the same.
    """
    runs = list(runs)
    while len(runs) >= fan_in:
        last = runs[-fan_in:]
        rows = sum(r.rows for r in last)
        if len({r.batches for r in last}) > 1 or rows > most_rows:
            break
        runs[-fan_in:] = [Run(last[0].first, last[-1].last, rows)]
    return runs


def last_batch(spark: SparkSession, folder: str) -> int | None:
    """The last batch that has a complete folder there."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in children(spark, folder) if n.startswith(BATCH)]
    complete = (n for n in sorted(found, reverse=True) if is_complete(spark, f"{folder}/{BATCH}={n}"))
    return next(complete, None)


@dataclass(frozen=True)
class Runs:
    """The runs below ``base``, which all executors must share.

    Rows have the columns of ``schema`` and the batch that brought them. The files of a run are sorted by ``order``, so
    that readers of few values of its first column open few row groups and pages; files of compacted runs hold
    ranges that lie apart, so that they open few files, too. A batch's own run is not shuffled for that.
    """

    base: str
    schema: T.StructType
    order: Sequence[str]
    fan_in: int = FAN_IN
    most_rows: int = MAX_RUN_ROWS

    def folder(self, run: Run) -> str:
        return f"{self.base}/rows/run={run.first}-{run.last}"

    def list_after(self, batch_id: int) -> str:
        return f"{self.base}/lists/{BATCH}={batch_id}"

    def after(self, spark: SparkSession, batch_id: int | None = None) -> list[Run]:
        """The runs that hold all rows after a batch, the last one if none is named."""
        if batch_id is None:
            batch_id = last_batch(spark, f"{self.base}/lists")
        if batch_id is None or batch_id < 0:
            return []
        rows = spark.read.schema(LIST_SCHEMA).parquet(self.list_after(batch_id)).collect()
        return sorted((Run(*r) for r in rows), key=lambda r: r.first)

    def read(self, spark: SparkSession, runs: list[Run] | None = None) -> DataFrame:
        """The rows of runs, by default of all."""
        shape = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        folders = [self.folder(r) for r in (self.after(spark) if runs is None else runs) if r.rows]
        return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)

    def append(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Append a batch; returns its rows as they are stored, to be read before the next batch is appended."""
        spark = rows.sparkSession
        before = self.after(spark, batch_id - 1)
        own = Run(batch_id, batch_id, 0)
        self.write(rows.select(*self.schema.names, F.lit(batch_id).cast("long").alias(BATCH)), own)
        own = Run(batch_id, batch_id, spark.read.parquet(self.folder(own)).count())
        after = compacted([*before, own], self.fan_in, self.most_rows)
        if after[-1] != own:
            self.write(self.read(spark, [r for r in [*before, own] if r.first >= after[-1].first]), after[-1])
        listed = spark.createDataFrame([(r.first, r.last, r.rows) for r in after], LIST_SCHEMA)
        listed.coalesce(1).write.mode("overwrite").parquet(self.list_after(batch_id))
        self._forget(spark, batch_id)
        return self.read(spark, [own])

    def write(self, rows: DataFrame, run: Run) -> None:
        apart = rows.repartitionByRange(*self.order) if run.batches > 1 else rows
        (
            apart.sortWithinPartitions(*self.order)
            .write.mode("overwrite")
            .option("compression", COMPRESSION)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .parquet(self.folder(run))
        )

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Remove lists that no batch and no reader needs any more, and the runs that only they name.

        The list after the batch before is kept, as this batch may be run again from it; so are those before, which a
        reader may have just chosen.
        """
        old = batch_id - KEPT_BATCHES
        if old >= 0 and is_complete(spark, self.list_after(old)):
            still = set(self.after(spark, old + 1))
            for run in {*self.after(spark, old), Run(old + 1, old + 1, 0)}:
                if all((run.first, run.last) != (r.first, r.last) for r in still):
                    delete(spark, self.folder(run))
            delete(spark, self.list_after(old))
