"""SparkSession factory for local runs, tests and the bench; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "quarrylight", cpus: int | None = None, partitions: int | None = None, **extra: str) -> SparkSession:
    """A local session: UTC, AQE on, shuffle partitions sized to the cores."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
