"""Session settings the jobs are written for (a caller may bring its own session)."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a shuffle partition that one hot key made too large
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str = "tallyline", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
