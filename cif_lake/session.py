"""Session settings the library relies on; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cif_lake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CIF_LAKE_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
