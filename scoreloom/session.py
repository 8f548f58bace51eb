"""Session settings for local runs; on a cluster the submitted session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "scoreloom", cpus: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Adaptive execution stays on, as on a cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small files are cut into as many splits as there are cores
        .config("spark.sql.files.minPartitionNum", cpus if cpus.isdigit() else "8")
        .config("spark.sql.files.openCostInBytes", "256k")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
