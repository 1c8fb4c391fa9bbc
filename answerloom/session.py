"""Session settings shared by tests and benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, name: str = "answerloom") -> SparkSession:
    n = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
