"""Session with the settings that the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """UTC, ANSI, adaptive execution; partition counts stay with the cluster unless given."""
    builder = SparkSession.builder.appName("quillspark")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
