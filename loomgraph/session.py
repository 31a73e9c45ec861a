"""A session with the settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """AQE with skew handling, UTC, Arrow; anything may be overridden by ``conf``."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    b = SparkSession.builder.appName("loomgraph")
    if master:
        b = b.master(master)
    return b.config(map=base | conf).getOrCreate()
