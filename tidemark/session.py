"""The session that tests, benchmarks and notebooks use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemark", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution, dynamic partition overwrite; on a cluster, master and partitions come from its own settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.driver.memory", conf.pop("driver_memory", "12g")).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
