"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that hold for every deployment; sizes (partitions, memory) are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "quillstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app).config(map={**DEFAULTS, **conf})
    return (builder.master(master) if master else builder).getOrCreate()
