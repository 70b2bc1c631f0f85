"""Session settings the library is meant to run with."""

from pyspark.sql import SparkSession


def build_session(app_name: str = "tillroll", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC timestamps.

    Leave ``master`` unset under spark-submit. The number of shuffle partitions
    stays the cluster's own setting; adaptive execution merges small ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
