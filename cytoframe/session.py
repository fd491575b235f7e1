"""Session defaults of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "cytoframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; keyword names hold ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Planes of images are long rows: what goes to Python at once is bounded by bytes.
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        # Checkpoint files go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
