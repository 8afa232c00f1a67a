"""Session settings shared by the tests, the bench and small jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session with the settings every operator here assumes: UTC and adaptive execution.

    On a cluster the caller's own session is used; nothing in the package needs a setting that
    only this builder makes.
    """
    b = (
        SparkSession.builder.master(master)
        .appName("millrace")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
    )
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
