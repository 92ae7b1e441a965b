"""Session builder with the settings the engine is tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


INITIAL_PARTITIONS, ADVISORY_SIZE = 100_000, "256m"


def build_session(app: str = "paritas", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on, UTC, and no UI.

    On a cluster leave ``master`` unset and let spark-submit decide. Shuffles then start from ``INITIAL_PARTITIONS``, which
    adaptive execution coalesces to about ``ADVISORY_SIZE`` each: 100 TB then make partitions that fit a task's memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if master and master.startswith("local"):
        cores = os.cpu_count() or 8
        settings["spark.sql.shuffle.partitions"] = str(cores)
    else:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(INITIAL_PARTITIONS)
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = ADVISORY_SIZE
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
