"""Session for local runs; on a cluster the caller brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


# HotSpot does not compile methods above 8000 bytes of bytecode. With this limit a plan whose generated method grows
# larger runs as smaller compiled pieces, several times faster for the long pricing and encoding expressions.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

# Rows that are blocks of many numbers go to Python by size, not by 10,000.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))

# Layers and scratch tables take a fifth to a quarter less space than with snappy, in the same time.
CODEC = ("spark.sql.parquet.compression.codec", "zstd")


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings that the long expressions profit from; a value the caller chose stays."""
    key, value = METHOD_LIMIT
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, value)
    for key, value in (BATCH_BYTES, CODEC):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str | None = None) -> SparkSession:
    cores = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("premia")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)
