"""Session settings for tests and the benchmark. On a cluster, use the session you are given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "wikiloom", cpus: int | str = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("WIKILOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
