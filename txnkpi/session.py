"""A session for running the stages from the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the results rely on; everything else is the cluster's choice.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def create_session(name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
