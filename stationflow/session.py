"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app_name: str = "stationflow", **settings: str) -> SparkSession:
    """A session with adaptive execution, UTC times and ANSI checks.

    The master and the number of shuffle partitions come from SPARK_MASTER_URL and SPARK_SHUFFLE_PARTITIONS when
    they are set, else from the way the application was submitted. Adaptive execution merges small shuffle
    partitions, so the number should suit the largest shuffle.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if os.getenv("SPARK_MASTER_URL"):
        builder = builder.master(os.environ["SPARK_MASTER_URL"])
    if os.getenv("SPARK_SHUFFLE_PARTITIONS"):
        builder = builder.config("spark.sql.shuffle.partitions", os.environ["SPARK_SHUFFLE_PARTITIONS"])
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
