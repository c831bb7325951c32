"""Session settings the engine is written for. On a cluster the submitter's settings win; these are for local use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | None = None, **settings: str) -> SparkSession:
    """A session on ``local[cores]`` with few shuffle partitions, for tests and the bench."""
    n = cores or os.cpu_count() or 1
    b = SparkSession.builder.master(f"local[{n}]").appName("loomset").config(map=SETTINGS)
    b = b.config("spark.sql.shuffle.partitions", str(n)).config("spark.driver.memory", "8g").config("spark.driver.host", "127.0.0.1")
    spark = b.config(map=settings).getOrCreate() if settings else b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
