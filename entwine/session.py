"""Session defaults for tests and local runs; a cluster brings its own session."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.debug.maxToStringFields": "200",
}


def local_session(cores: str = "8", app: str = "entwine", **conf: str) -> SparkSession:
    """A local session; `conf` overrides DEFAULTS."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": cores, "spark.driver.memory": "8g"} | conf
    return builder.config(map=settings).getOrCreate()
