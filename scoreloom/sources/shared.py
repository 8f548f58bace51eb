"""The shared folder and the tables published into it.

Published tables cut lineage and survive the loss of executors, because they live in the
folder that the cluster names, not in executor memory or on a worker's disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from scoreloom.sources.files import delete

SETTING = "spark.checkpoint.dir"
COMPRESSION = "zstd"  # of published tables


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where it is unset and
    all work runs in one process, as in tests."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="scoreloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def own_run() -> Iterator[str]:
    """What is published inside lies in a folder of its own, whose name is given, to be removed by ``remove_run``."""
    before = _RUN.set(uuid.uuid4().hex)
    try:
        yield _RUN.get()
    finally:
        _RUN.reset(before)


def run_folder(spark: SparkSession, run: str | None = None) -> str:
    """The folder of a run, by default of the present one; outside of any, of the application."""
    name = run or _RUN.get() or spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/scoreloom/{name}"


def remove_run(spark: SparkSession, run: str | None = None) -> bool:
    """Remove what a run has published, by default the application outside of ``own_run``; whether there was something.

    To be called when no result that reads it is needed any more.
    """
    return delete(spark, run_folder(spark, run))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the present run, never used before."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def publish(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of it.

    For results that several branches of a plan read: the work behind them runs once, and
    the reader's size is known to Spark when it chooses join strategies.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
