"""A session with the settings this library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, name: str = "tenantry", memory: str = "8g") -> SparkSession:
    """Local session for tests and benches; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # recording call sites slows plan building
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )
