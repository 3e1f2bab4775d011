"""A session with the settings that this library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tessella", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC times, adaptive plans with skew handling; partitions default to the cluster's setting."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
