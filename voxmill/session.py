"""The Spark session that tests, the bench and small jobs use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with UTC time and adaptive execution; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxmill")
        .config("spark.driver.memory", os.environ.get("VOXMILL_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
