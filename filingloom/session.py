"""Session helpers for local runs. On a cluster the submitter owns the session and its settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "filingloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; never used on a cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # a job has more generated classes than the default cache holds; keep them across runs
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # do not record a Python stack for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="filingloom-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
