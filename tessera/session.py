"""A local session for tests and benchmarks; clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessera")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
