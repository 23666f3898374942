"""Sessions for local runs; on a cluster the caller brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoints: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoints:
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
