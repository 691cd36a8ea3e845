"""A session with the settings that the models rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "cairnbook", **settings: str) -> SparkSession:
    """UTC, adaptive execution, Arrow; ANSI mode stays on. Other settings override by name, with _ for each dot.

    Master and shuffle partitions are the caller's: spark-submit's, or, for a run in one process, those of $SPARK_MASTER or
    ``local`` below.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if os.environ.get("SPARK_MASTER"):
        builder = builder.master(os.environ["SPARK_MASTER"])
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def local(cores: str | int, app: str = "cairnbook", **settings: str) -> SparkSession:
    """A session in this process, with as many shuffle partitions as cores and no UI: for tests and bench."""
    own = {"spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": str(cores), "spark.ui.enabled": "false"}
    return get_session(app, **own | settings)
