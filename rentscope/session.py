"""Session set-up for scripts, benches and tests. Library code takes the caller's session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session in UTC, with adaptive execution and without the web page."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rentscope")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Hour, weekday and day truncation are defined on UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
