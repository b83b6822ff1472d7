"""The session that tests, the bench and the command line use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "feedloom", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """UTC, adaptive execution and, unless the cluster says otherwise, as many shuffle partitions as asked for."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
