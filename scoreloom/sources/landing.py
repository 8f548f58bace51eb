"""The landing zone: one raw match document per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.schemas import RAW_SCHEMA


FILE = "file"  # the column that names the file of a document
COMPRESSION = "gzip"
DOCUMENTS_PER_FILE = 1 << 17


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed documents as one string column; nothing is parsed or inferred."""
    return spark.read.text(path).withColumnRenamed("value", "json_payload")


def stream_documents(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    with_file: bool = False,
) -> DataFrame:
    """The same as a stream of newly landed files, so many or so much of them at a time.

    ``with_file`` adds the name of the file that a document comes from.
    """
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    file = [F.col("_metadata.file_path").alias(FILE)] if with_file else []
    return reader.load(path).select(F.col("value").alias("json_payload"), *file)


def land_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write documents to the landing zone, in parallel, one per line.

    Files are compressed, as documents repeat the same keys. A compressed file is read by one task, so none holds more
    than ``DOCUMENTS_PER_FILE``.
    """
    lines = documents.select(F.col("json_payload").alias("value")).write.mode(mode)
    lines.option("compression", COMPRESSION).option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(path)


def documents_from_strings(spark: SparkSession, payloads: list[str | None]) -> DataFrame:
    """A handful of documents given as Python strings, as in tests."""
    return spark.createDataFrame([(p,) for p in payloads], RAW_SCHEMA)
