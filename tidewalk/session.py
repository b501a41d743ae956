"""A session with the settings the plans assume."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions and splits skewed join partitions. Model fits run side by side in pools of
# their own. The call-site capture of the Python
# DataFrame API costs milliseconds per expression, more than planning does.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", work_dir: str | None = None, **settings) -> SparkSession:
    """A local session; on a cluster, pass SETTINGS to the usual builder instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidewalk").config("spark.driver.memory", memory)
    partitions = os.cpu_count() if cores == "*" else cores
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if work_dir is not None:
        builder = builder.config("spark.checkpoint.dir", work_dir)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
