"""Session settings the plans are written for."""

from pyspark.sql import SparkSession


def build_session(name: str = "pondside", **settings: str) -> SparkSession:
    """A session with adaptive execution and UTC dates; `settings` override (dots as `__`)."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    options.update({key.replace("__", "."): value for key, value in settings.items()})
    builder = SparkSession.builder.appName(name)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
