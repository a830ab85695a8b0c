"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Reports aggregate ~140 columns in one pass; above this many fields Spark
    # leaves whole-stage code generation.
    "spark.sql.codegen.maxFields": "500",
    # Tables in buckets of the match are joined on more than the match without moving them again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "scrimlens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
