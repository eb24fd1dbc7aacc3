"""A session with the settings the operators rely on; any existing session with UTC time works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The session time zone makes timestamps without a zone mean UTC. The rest are Spark's adaptive features: they size
# shuffle partitions by measured bytes and split partitions that hold a hot key. Recording the Python line of
# every expression is off: the wide projections of raw records have many thousands of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "viewloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
